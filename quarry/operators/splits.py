"""Group-pure, chronological, purged splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import HOUR_US

SPLITS = ("train", "validation", "test")


def group_splits(samples: DataFrame, group: str, *, targets: Sequence[float] = (0.7, 0.15, 0.15), time: str = "anchor_us") -> DataFrame:
    """(group, median_us, rows, split): groups in order of their median time, cut twice so that sizes come
    nearest to ``targets`` and no split is empty; of equal cuts the first.

    Cuts are sought on one row per group. Fewer than three groups give two splits.
    """
    # one row per group from here on; the global order is over groups, not over samples
    groups = samples.groupBy(group).agg(F.median(time).alias("median_us"), F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy("median_us", group)
    upto = groups.withColumns(
        {
            "k": F.row_number().over(order),
            "upto": F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.sum("rows").over(Window.partitionBy()),
            "n": F.count(F.lit(1)).over(Window.partitionBy()),
        }
    )
    a, b, c = targets
    u1, u2, total = F.col("u1"), F.col("u2"), F.col("total")
    off = F.abs(u1 - F.lit(a) * total) + F.abs(u2 - u1 - F.lit(b) * total) + F.abs(total - u2 - F.lit(c) * total)
    # for one first cut the deviation is convex in u2 and least between these two values, so the best second
    # cut is the first at or after the lesser one, the last before it, or the next group
    lesser = F.least(F.col("upto") + F.lit(b) * total, F.lit(1 - c) * total)
    inner = upto.where("k < n")
    cuts = inner.select(F.col("k").alias("c"), F.col("upto").cast("double").alias("at"), F.lit(1).alias("point"), F.lit(None).cast("struct<c1: int, u1: bigint>").alias("one"), "upto", "total")
    wanted = inner.select(F.lit(None).cast("int").alias("c"), lesser.alias("at"), F.lit(0).alias("point"), F.struct(F.col("k").alias("c1"), F.col("upto").alias("u1")).alias("one"), F.lit(None).cast("long").alias("upto"), "total")
    along = Window.orderBy("at", "point", "c")
    back = Window.orderBy(F.col("at").desc(), F.col("point").desc(), F.col("c").desc())
    cut = F.when(F.col("point") == 1, F.struct(F.col("c").alias("c2"), F.col("upto").alias("u2")))
    near = cuts.unionByName(wanted).select(
        "one", "total", F.last(cut, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("x"),
        F.last(cut, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("y"),
    ).where("one IS NOT NULL").select("one.*", "total", F.explode(F.array("x", "y")).alias("s"))
    following = inner.select(
        F.col("k").alias("c1"), F.col("upto").alias("u1"), "total",
        F.struct(F.lead("k").over(order).alias("c2"), F.lead("upto").over(order).alias("u2")).alias("s"),
    )
    pairs = near.unionByName(following).select("c1", "u1", "total", "s.*").where("c2 > c1").select("c1", "c2", off.alias("off"))
    two = upto.where("n < 3 AND (k < n OR n = 1)").select(F.col("k").alias("c1"), F.col("n").cast("int").alias("c2"), F.abs(F.col("upto") - F.lit(a) * total).alias("off"))
    best = pairs.unionByName(two).orderBy(F.round("off", 6), "c1", "c2").limit(1)
    split = F.when(F.col("k") <= F.col("c1"), SPLITS[0]).when(F.col("k") <= F.col("c2"), SPLITS[1]).otherwise(SPLITS[2])
    return upto.join(F.broadcast(best)).select(group, "median_us", "rows", split.alias("split"))  # best: one row


def purge(samples: DataFrame, hours: float, *, time: str = "anchor_us", both_sides: bool = False) -> DataFrame:
    """Mark rows near a border between splits as ``purged``.

    A border lies midway between the last row of one split and the first of the next.
    Rows of the earlier split after border - hours and rows of the later one before
    border + hours go; with ``both_sides`` every row of the band goes, ends included.
    """
    ranges = samples.groupBy("split").agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    one = ranges.groupBy().agg(
        *(F.max(F.when(F.col("split") == s, F.col(c))).alias(f"{c}_{s}") for s in SPLITS for c in ("lo", "hi"))
    )
    middle = lambda x, y: (F.col(f"hi_{x}") + F.col(f"lo_{y}")) / 2
    borders = one.select(middle("train", "validation").alias("_b1"), middle("validation", "test").alias("_b2"))
    t, band = F.col(time), hours * HOUR_US
    if both_sides:
        near = (F.abs(t - F.col("_b1")) <= band) | (F.abs(t - F.col("_b2")) <= band)
    else:
        s = F.col("split")
        near = (
            ((s == "train") & (t > F.col("_b1") - band)) | ((s == "validation") & (t < F.col("_b1") + band))
            | ((s == "validation") & (t > F.col("_b2") - band)) | ((s == "test") & (t < F.col("_b2") + band))
        )
    marked = samples.join(F.broadcast(borders))  # borders: one row
    return marked.withColumn("split", F.when(F.coalesce(near, F.lit(False)), "purged").otherwise(F.col("split"))).drop("_b1", "_b2")


def time_splits(samples: DataFrame, *, cuts: Sequence[float] = (0.7, 0.85), by: Sequence[str], slices: int = 256) -> DataFrame:
    """Splits by share of rows in order of ``by`` (unique; the first a number), cut at half-even rounded counts.

    Rows are ranked inside slices of the first column, cut at its approximate
    quantiles, and moved up by the counts of the slices before, so no task sees the
    whole table. A row's slice depends on nothing but its value.
    """
    shares = [k / slices for k in range(1, slices)]
    bounds = sorted(set(samples.agg(F.percentile_approx(by[0], shares).alias("b")).first()["b"] or []))
    slice_ = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(by[0]))) if bounds else F.lit(0)
    placed = samples.withColumn("_part", slice_)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("_total")
    )
    numbered = placed.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*by)))
    place = F.col("_start") + F.col("_in")
    one, two = (F.bround(F.col("_total") * F.lit(c), 0) for c in cuts)
    split = F.when(place <= one, SPLITS[0]).when(place <= two, SPLITS[1]).otherwise(SPLITS[2])
    # one row per slice
    return numbered.join(F.broadcast(starts), F.col("_part") == F.col("_p")).select(*samples.columns, split.alias("split"))


def split_report(samples: DataFrame, group: str, *, time: str = "anchor_us") -> DataFrame:
    """Rows, groups and time range of each split."""
    return samples.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(group).alias("groups"), F.min(time).alias("first_us"), F.max(time).alias("last_us")
    )


def group_overlap(samples: DataFrame, group: str) -> DataFrame:
    """Groups that stand in more than one split (none, if the split is pure)."""
    return samples.where("split <> 'purged'").groupBy(group).agg(F.countDistinct("split").alias("splits")).where("splits > 1").select(group)


def turns(sizes: Sequence[tuple[int, int]], folds: int) -> list[tuple[int, int, int, list[int]]]:
    """For ``(size, groups)`` in falling order of size the stretches ``(size, first, end, folds in turn)``
    of groups, each to the fold that has the fewest rows when its turn comes.

    Folds within one group's size of the least take turns until another comes near, so a
    size has no more stretches than there are folds, however many groups it has.
    """
    load, out = [0] * folds, []
    for size, groups in sizes:
        at = 0
        while at < groups:
            order = sorted(range(folds), key=lambda k: (load[k], k))
            least = load[order[0]]
            near = [k for k in order if load[k] < least + size]
            rounds = min([(load[k] - least) // size for k in order[len(near) :]], default=groups)
            end = min(groups, at + rounds * len(near))
            for i, k in enumerate(near):
                load[k] += size * ((end - at - i + len(near) - 1) // len(near))
            out.append((size, at, end, near))
            at = end
    return out


def group_folds(rows: DataFrame, group: str, folds: int = 5) -> DataFrame:
    """(group, fold): the largest group first, then by name, each to the fold with the fewest rows.

    The driver sees how many groups there are of each size, not the groups. Rows without a group have no fold.
    """
    sizes = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    histogram = sizes.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("_size").desc()).collect()
    stretches = rows.sparkSession.createDataFrame(
        turns([(r["_size"], r["n"]) for r in histogram], folds), "_size long, _first long, _end long, _turns array<int>"
    )
    placed = sizes.withColumn("_at", F.row_number().over(Window.partitionBy("_size").orderBy(group)) - 1)
    here = placed.join(stretches, "_size").where("_at >= _first AND _at < _end")
    return here.select(group, F.get("_turns", ((F.col("_at") - F.col("_first")) % F.size("_turns")).cast("int")).alias("fold"))
