"""Quality rules: gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .storage import extended
from .text_stats import COUNTS, SHAPE, text_stats

#: Features, and the direction in which quality may move with each (0: free).
FEATURES = {
    "log_words": 0,
    "symbols_per_char": -1,
    "dup_lines_per_line": -1,
    "repeats_per_word": -1,
    "chars_per_word": 0,
    "upper_per_char": -1,
    "digits_per_char": 0,
    "exclaims_per_word": -1,
    "distinct_per_word": 0,
}
STATS_SCHEMA = ", ".join(f"{c} long" for c in (*COUNTS, *SHAPE))


def features(stats: np.ndarray) -> np.ndarray:
    """Rows of COUNTS and SHAPE values to rows of FEATURES."""
    words, chars, symbols, dup, repeats, lines, distinct, upper, digits, exclaims = stats.astype(float).T
    per_word, per_char = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack(
        [
            np.log1p(words), symbols / per_char, dup / np.maximum(lines, 1), repeats / per_word, chars / per_word,
            upper / per_char, digits / per_char, exclaims / per_word, distinct / per_word,
        ],
        axis=1,
    )


def with_stats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    model: boosting.FlatTrees | None = None,
) -> DataFrame:
    """doc_id, the columns named in ``keep``, the statistics of the whole text, and score.

    score is the model's probability of good quality, 1 without a model.
    """
    carried = docs.select(F.col(key).alias("doc_id"), *keep, F.col(text).alias("_text"))
    rest = [c for c in carried.columns if c != "_text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([text_stats(t) for t in batch.column("_text").to_pylist()], np.int64)
            table = table.reshape(-1, len(COUNTS) + len(SHAPE))
            score = np.ones(len(table)) if model is None else model.probability(features(table))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(col) for col in (*table.T, score)],
                names=[*rest, *COUNTS, *SHAPE, "score"],
            )

    return carried.mapInArrow(count, extended(carried, rest, f"{STATS_SCHEMA}, score double"))


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, seed: int = 7) -> boosting.FlatTrees | None:
    """Fit on labelled rows, about ``max_rows`` of them at most, chosen by a hash of doc_id.

    Returns None where no row is labelled or all have one label: then nothing can be
    learnt. Only the statistics of the sample reach the driver. Labels that are null
    are left out.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    total = known.count()
    if not total:
        return None
    share = min(1.0, max_rows / total)
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the sample is bounded by max_rows, so its ids may be broadcast; an id of several rows counts once, by its least statistics
    rows = with_stats(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), keep=("quality",))
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*rows.columns[1:])).alias("s")).select("doc_id", "s.*")
    sample = one.toPandas().sort_values("doc_id")
    y = sample["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    x = features(sample[[*COUNTS, *SHAPE]].to_numpy())
    return boosting.fit(x, y, np.array(list(FEATURES.values())))


def judge(docs: DataFrame, model: boosting.FlatTrees | None, *, threshold: float = 0.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Statistics, base_failed, score (0 to 1) and kept for every row.

    kept is false where the base rule fails, else whether the score reaches
    ``threshold``; without a model every row that passes the base rule is kept, with
    score 1. Null and empty texts have 0 words and so fail. Null ids and repeated rows
    are judged like any other, each row by its own text. Columns besides doc_id, text
    and ``keep`` are not read. An empty table gives an empty result.
    """
    judged = with_stats(docs, keep=keep, model=model).withColumn(
        "base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
