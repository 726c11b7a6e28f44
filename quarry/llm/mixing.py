"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed 60-bit hash of its key and its text. A source's sample is the set of rows
whose hash lies below one threshold, so samples for growing budgets are nested, reruns
agree, and applying a mix is a filter. The threshold comes from histograms of tokens
by hash bucket: the bucket in which the running sum passes the budget is refined by
the next bits, and only its rows are read again. Nothing is sorted by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import settle

HASH_BITS = 60
LEVEL_BITS = 15
WORD = r"[^\x20\x09-\x0D]+"


def row_hash(key: Column, text: Column) -> Column:
    """60 bits of md5 over the key and the text's own md5; nulls hash as empty texts.

    The text tells apart rows that share a key or have none.
    """
    own = F.coalesce(F.md5(text.cast("binary")), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(" "), own).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Targets by weight, none above ``most`` times its source, for rows (source, source_size).

    Sources in code-point order, null last, take the weights in turn. Let the sources
    be sorted by cap / weight and level k be what remains after the caps of the
    sources before k, over the weights from k on. The level rises while caps bind and
    falls afterwards, so its greatest value is the level at which nothing is above
    its cap any more.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    by_fill = Window.orderBy((F.col("_cap") / F.col("_weight")), F.col("_rank"))
    everything = Window.partitionBy()
    level = (F.col("_total") * share - F.coalesce(F.sum("_cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / (
        F.sum("_weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    )
    return (
        sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumns({"_weight": pick, "_cap": cap, "_total": F.sum("source_size").over(everything)})
        .withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_level")).alias("target"),
        )
    )


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole_copies, and the hash up to which rows get one copy more.

    ``passed`` is true where the row (or rows) at the threshold bring the sum nearer
    to the target than leaving them out does.
    """
    positive = F.col("source_size") > 0
    found = targets.withColumn(
        "whole_copies", F.when(positive, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    ).select(
        "source", "source_size", "target", "whole_copies",
        (F.col("target") - F.col("whole_copies") * F.col("source_size")).alias("_rest"),
        F.lit(0).cast("long").alias("_bucket"), F.lit(0).cast("long").alias("_before"),
        F.lit(0).cast("long").alias("_inside"),
    )
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        boundary = found.select(F.col("source").alias("_s"), "_rest", "_bucket", "_before")
        inside = rows.join(
            boundary, rows["source"].eqNullSafe(F.col("_s")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("_bucket"))
        )
        sums = inside.groupBy("_s", F.shiftright("hash", shift).alias("_next"), "_rest", "_before").agg(
            F.sum("size").alias("_sum")
        )
        upto = Window.partitionBy("_s").orderBy("_next").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        crossing = (
            sums.withColumn("_upto", F.col("_before") + F.sum("_sum").over(upto))
            .where((F.col("_upto") > F.col("_rest")) & (F.col("_upto") - F.col("_sum") <= F.col("_rest")))
            .select("_s", "_next", (F.col("_upto") - F.col("_sum")).alias("_start"), "_sum")
        )
        # a source whose rest is never passed has no boundary; its bucket stays above all hashes
        # one row per source, written so that the next level's joins are planned by its size
        found = settle(found.drop("_bucket", "_before", "_inside").join(
            crossing, found["source"].eqNullSafe(F.col("_s")), "left"
        ).select(
            "source", "source_size", "target", "whole_copies", "_rest",
            F.coalesce("_next", F.lit(1 << (HASH_BITS - shift))).alias("_bucket"),
            F.coalesce("_start", F.lit(0)).alias("_before"), F.coalesce("_sum", F.lit(0)).alias("_inside"),
        ), f"mix-level-{shift}")
    return found.select(
        F.col("source").alias("__mix_source"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target"),
        F.col("whole_copies").alias("__mix_whole"), F.col("_bucket").alias("__mix_threshold"),
        ((F.col("_before") + F.col("_inside") - F.col("_rest")) < (F.col("_rest") - F.col("_before"))).alias("__mix_passed"),
    )


def plan(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, source, size, hash), and the limits of every source that ``copies`` needs."""
    rows = settle(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            row_hash(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("hash"),
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settle(source_targets(sizes, weights, share, most), "mix-targets")
    return rows, settle(_thresholds(rows, targets).withColumn("__mix_most", F.lit(most)), "mix-limits")


def _with_copies(rows: DataFrame, limits: DataFrame, source: str, place: Column) -> DataFrame:
    """Rows with their source's limits and __mix_copies; the prefix keeps clear of the rows' own columns."""
    threshold = F.col("__mix_threshold")
    extra = (place < threshold) | ((place == threshold) & F.col("__mix_passed"))
    copies = F.least(F.col("__mix_most"), F.col("__mix_whole") + F.when(extra, 1).otherwise(0))
    return rows.join(limits, F.col(f"`{source}`").eqNullSafe(F.col("__mix_source"))).withColumn("__mix_copies", copies.cast("int"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2, **columns: str) -> DataFrame:
    """How often each row enters a mix of ``share`` times the corpus.

    Size is the number of words. Returns doc_id, source, size, source_size, target,
    copies (0 to ``most``) and taken (copies times size). Each source's taken words
    miss its target by at most half its largest group of rows with one key and one text.

    Null text counts 0 words; a null source is a source of its own, last in order.
    Wholly repeated rows share a hash and so one decision; null keys are told apart by text.
    A source without words gets target 0. Empty tables give an empty result. Other
    columns are not read. The per-source tables are not hinted for broadcast; the
    planner decides by their measured size, and a hot source is split by it.
    """
    rows, limits = plan(docs, weights, share, most, **columns)
    return _with_copies(rows, limits, "source", F.col("hash")).select(
        "doc_id", "source", "size", F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"),
        F.col("__mix_copies").alias("copies"), (F.col("__mix_copies") * F.col("size")).cast("long").alias("taken"),
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as ``mix`` says, same columns."""
    _, limits = plan(docs, weights, share, most, key=key, text=text, source=source)
    counted = _with_copies(docs, limits, source, row_hash(F.col(f"`{key}`"), F.col(f"`{text}`")))
    again = F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))).alias("__mix_turn")
    return counted.where("__mix_copies > 0").select(*(F.col(f"`{c}`") for c in docs.columns), again).drop("__mix_turn")
