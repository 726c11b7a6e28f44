"""Ranking metrics, threshold trade-offs, scalers and reports from aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators import quantiles


def _curve(scored: DataFrame, by: Sequence[str], probability: str, label: str) -> DataFrame:
    """Per group and distinct score the positives and rows at or above it, summed by slices of scores."""
    part = quantiles.slice_of(scored, probability)
    values = scored.groupBy(*by, probability).agg(F.sum(label).alias("pos"), F.count(F.lit(1)).alias("n"))
    upto = quantiles.running_sums(values, by, probability, ["pos", "n"], part)
    return upto.select(
        *by, probability, "pos", "n", (F.col("pos_all") - F.col("pos_upto") + F.col("pos")).alias("tp"),
        (F.col("n_all") - F.col("n_upto") + F.col("n")).alias("seen"), F.col("pos_all").alias("positives"), F.col("n_all").alias("total"),
    )


def ranking_metrics(scored: DataFrame, by: Sequence[str] = ("fold",), probability: str = "probability", label: str = "y") -> DataFrame:
    """Average precision (step-wise), area under the ROC curve and best F1 per group; equal scores count as one step."""
    c = _curve(scored, by, probability, label)
    precision = F.col("tp") / F.col("seen")
    f1 = 2 * F.col("tp") / (F.col("seen") + F.col("positives"))
    negatives = F.col("n") - F.col("pos")
    below = (F.col("total") - F.col("positives")) - (F.col("seen") - F.col("tp"))  # negatives with a lower score
    return c.groupBy(*by).agg(
        (F.sum(F.col("pos") * precision) / F.max("positives")).alias("average_precision"),
        F.when(
            (F.max("positives") > 0) & (F.max("total") > F.max("positives")),
            F.sum(F.col("pos") * (below + negatives / 2)) / (F.max("positives") * (F.max("total") - F.max("positives"))),
        ).alias("roc_auc"),
        F.max(f1).alias("best_f1"),
    )


def threshold_sweep(scored: DataFrame, days: float, thresholds: Sequence[float], probability: str = "probability", label: str = "y") -> DataFrame:
    """Hits, false alarms, misses, precision, recall, F1 and alerts a day at each threshold that alerts at all.

    All thresholds are counted in one pass; no row is repeated per threshold.
    """
    p, y = F.col(probability), F.col(label)
    counts = [
        F.struct(
            F.lit(t).alias("threshold"), F.count_if((p >= t) & (y == 1)).alias("tp"), F.count_if((p >= t) & (y == 0)).alias("fp"),
            F.count_if((p < t) & (y == 1)).alias("fn"),
        )
        for t in thresholds
    ]
    rows = scored.agg(F.array(*counts).alias("a")).select(F.explode("a").alias("s")).select("s.*").where("tp + fp > 0")
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return rows.withColumns({"precision": precision, "recall": recall}).withColumns(
        {"f1": 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")), "alerts_per_day": (F.col("tp") + F.col("fp")) / days}
    )


def operating_points(sweep: DataFrame, *, least_recall: float = 0.5, most_alerts: float = 2.0) -> DataFrame:
    """The best F1 with enough recall, and with few enough alerts; without any, the best recall or the fewest alerts."""
    best = lambda ok, f: F.max_by("threshold", F.when(ok, f))
    order = F.struct("f1", "threshold")
    return sweep.agg(
        F.coalesce(best(F.col("recall") >= least_recall, order), F.max_by("threshold", F.struct("recall", "threshold"))).alias("recall_first"),
        F.coalesce(
            best(F.col("alerts_per_day") <= most_alerts, order), F.max_by("threshold", F.struct(-F.col("alerts_per_day"), F.col("threshold")))
        ).alias("precision_first"),
    )


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of mean and std per column: mean 0 without values, std 1 where it is 0 or cannot be told."""
    out: list[Column] = []
    for c in columns:
        std = F.stddev_samp(c)
        out += [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}__mean"), F.when(std > 0, std).otherwise(1.0).alias(f"{c}__std")]
    return train.agg(*out)


def apply_scaler(rows: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    scaled = rows.crossJoin(F.broadcast(scaler))  # the scaler is one row
    new = {c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std") for c in columns}
    return scaled.withColumns(new).select(rows.columns)


def constant_columns(rows: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct value besides null."""
    row = rows.agg(*((F.min(c) != F.max(c)).alias(c) for c in columns)).first()
    return [c for c in columns if not row[c]]


#: Shares of rows in order of time before the cuts of expanding windows.
TIME_CUTS = (0.4, 0.6, 0.8)


def fold_sides(bounds: Sequence[float], gap_us: int, time: str = "anchor_us") -> list[Column]:
    """For each cut a row's side: ``train`` before the cut, ``test`` after cut + gap up to the next cut, else null."""
    t, ends = F.col(time), [*bounds[1:], None]
    tests = [(t >= cut + gap_us) & (F.lit(True) if end is None else t < end) for cut, end in zip(bounds, ends)]
    return [F.when(t < cut, "train").when(test, "test") for cut, test in zip(bounds, tests)]


def time_folds(scored: DataFrame, *, cuts: Sequence[float] = TIME_CUTS, gap_us: int, time: str = "anchor_us", label: str | None = None) -> DataFrame:
    """Rows per expanding-window fold: side ``train`` before the cut, ``test`` after cut + gap up to the next cut.

    With a ``label``, folds without a positive on one side are left out.
    """
    bounds = quantiles.exact_quantiles(scored, time, cuts)
    if None in bounds:
        return scored.withColumns({"fold": F.lit(0), "side": F.lit("train")}).where("false")
    sides = [F.struct(F.lit(k).alias("fold"), side.alias("side")) for k, side in enumerate(fold_sides(bounds, gap_us, time))]
    rows = scored.select("*", F.explode(F.array(*sides)).alias("_s")).select(*scored.columns, "_s.fold", "_s.side").where("side IS NOT NULL")
    if label is None:
        return rows
    both = rows.where(F.col(label) == 1).groupBy("fold").agg(F.countDistinct("side").alias("n")).where("n = 2")
    # both: a row per cut; joined by a shuffle, all rows of a fold would go to one task
    return rows.join(F.broadcast(both.select("fold")), "fold", "left_semi").select(*scored.columns, "fold", "side")
