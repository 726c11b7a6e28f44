"""Quality figures of a dataset in long form (section, name, value), and what is written about them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import quantiles

FIGURE = "section string, name string, value double"


def _figures(section: str, one: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Aggregates of a table as a row each."""
    named = F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in parts))
    return one.agg(*(c.alias(n) for n, c in parts.items())).select(F.explode(named).alias("f")).select(F.lit(section).alias("section"), "f.*")


def _counts(section: str, rows: DataFrame, column: str) -> DataFrame:
    """Rows of each value; null is a value."""
    return rows.groupBy(F.col(column).cast("string").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit(section).alias("section"), "name", "value")


def _spread(section: str, rows: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles of a column and its greatest value; no rows without values."""
    found = quantiles.exact_quantiles(rows, column, [*shares.values(), 1.0])
    listed = [(section, n, v) for n, v in zip([*shares, "max"], found, strict=True) if v is not None]
    return rows.sparkSession.createDataFrame(listed, FIGURE)


def quality_metrics(samples: DataFrame, evidence: DataFrame, windows: DataFrame, readings: DataFrame, *, keys: int = 50) -> DataFrame:
    """Counts of labels and reasons, freshness, balance of splits by device, evidence and its delay, outages, the busiest keys.

    ``samples`` have been through ``outages.eligibility``; ``evidence`` may have ``observed_us``.
    Tables are read once for each section, so give written ones. Without rows, counts are zero.
    """
    count, has = F.count_if, F.coalesce
    label = F.col("label_status")
    parts = [
        _figures(
            "samples", samples,
            {
                "total": F.count(F.lit(1)), "eligible": count(has("eligible", F.lit(False))), "excluded": count(~has("eligible", F.lit(False))),
                "anomaly_eligible": count(has("anomaly_eligible", F.lit(False))), "label_measured": count(label == "measured"),
                "label_censored": count(label == "censored"), "positive_labels": count(F.col("y") == 1), "devices": F.countDistinct("device_id"),
            },
        ),
        _counts("censor_reasons", samples, "censor_reason"),
        _spread("freshness_hours", samples, "last_age_h", {"p50": 0.5, "p90": 0.9, "p99": 0.99}),
    ]
    sizes = samples.groupBy("split", "device_id").agg(F.count(F.lit(1)).alias("n")).groupBy("split")
    balance = sizes.agg(F.count("n").cast("double").alias("count"), F.min("n").cast("double").alias("min"), F.max("n").cast("double").alias("max"), F.avg("n").alias("mean"))
    long = balance.unpivot("split", ["count", "min", "max", "mean"], "stat", "value")
    parts.append(long.select(F.lit("split_balance_by_device").alias("section"), F.concat_ws(".", "split", "stat").alias("name"), "value"))
    strong, weak = (F.col("evidence_strength") == s for s in ("strong", "weak"))
    each = evidence.groupBy("device_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(strong).alias("s"), F.count_if(weak).alias("w"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    parts += [
        _figures(
            "evidence", each,
            {
                "rows": total("n"), "devices_with_strong_evidence": count(F.col("s") > 0),
                "weak_only_devices": count((F.col("w") > 0) & (F.col("s") == 0)), "weak_evidence_rows": total("w"),
            },
        ),
        _counts("evidence_by_type", evidence, "evidence_type"), _counts("evidence_by_strength", evidence, "evidence_strength"),
        _figures("outage_windows", windows, {"total": F.count(F.lit(1)), "closed": count("window_closed")}),
    ]
    if "observed_us" in evidence.columns:
        late = evidence.select(((F.col("observed_us") - F.col("us")) / 1e6).alias("delay_s"))
        parts.append(_spread("observed_minus_evidence_seconds", late, "delay_s", {"p50": 0.5, "p90": 0.9}))
    by_key = readings.groupBy(F.col("key").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    parts.append(by_key.orderBy(F.col("value").desc(), "name").limit(keys).select(F.lit("coverage_by_key").alias("section"), "name", "value"))
    return reduce(DataFrame.unionByName, parts)


def markdown(title: str, figures: DataFrame, *, most: int = 1000) -> str:
    """A Markdown report with a table per section; figures are few by their making, and ``most`` lines are read."""
    ranked = figures.withColumn("_n", F.row_number().over(Window.partitionBy("section").orderBy(F.col("value").desc(), "name")))
    lines, section = [f"# {title}"], None
    for r in ranked.orderBy("section", "_n").limit(most).collect():
        if r["section"] != section:
            section = r["section"]
            lines += ["", f"## {section}", "", "| figure | value |", "|---|---|"]
        lines.append(f"| {'(none)' if r['name'] is None else r['name']} | {r['value']:.6g} |")
    return "\n".join([*lines, ""])


def write_report(text: str, figures: DataFrame, path: str) -> None:
    """The report as a text file and its figures as JSON lines, below ``path``."""
    figures.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{path}/report")
    figures.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/figures")


def aggregate_folds(folds: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation of the folds' metrics."""
    return folds.groupBy(*by).agg(F.count(F.lit(1)).alias("folds"), *(f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))))
