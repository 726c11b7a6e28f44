"""The daily grid: last value per day, unbounded fill, counts, gaps, hierarchy roll-ups and trends."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quarry.functions.scalars import DAY_US


def day_of(us: Column) -> Column:
    """Whole days since 1970 of a time in microseconds."""
    return F.floor(us / DAY_US).cast("long")


def daily_last(readings: DataFrame, start_day: int, end_day: int, *, by: Sequence[str] = ("device_id", "key")) -> DataFrame:
    """For every device, key and day the last value of the day, else of the days before.

    A reading that is null is a value too: it replaces what was carried.
    """
    value = F.struct("value_num")
    per_day = readings.groupBy(*by, day_of(F.col("us")).alias("day")).agg(F.max_by(value, F.struct("us", "arrival_seq")).alias("v"))
    days = F.explode(F.sequence(F.lit(start_day).cast("long"), F.lit(end_day).cast("long"))).alias("day")
    grid = readings.select(*by).distinct().select(*by, days)
    carried = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(per_day, [*by, "day"], "left").withColumn("v", F.last("v", ignorenulls=True).over(carried))
    return filled.select(*by, "day", F.col("v.value_num").alias("value_num"))


def daily_counts(readings: DataFrame, when: Column, start_day: int, end_day: int, *, by: Sequence[str] = ("device_id",)) -> DataFrame:
    """Readings per day for which ``when`` holds, zero where there are none."""
    counts = readings.groupBy(*by, day_of(F.col("us")).alias("day")).agg(F.count_if(when).alias("n"))
    days = F.explode(F.sequence(F.lit(start_day).cast("long"), F.lit(end_day).cast("long"))).alias("day")
    grid = readings.select(*by).distinct().select(*by, days)
    return grid.join(counts, [*by, "day"], "left").select(*by, "day", F.coalesce("n", F.lit(0)).alias("n"))


def daily_changes(readings: DataFrame, *, by: Sequence[str] = ("device_id", "key")) -> DataFrame:
    """Changes of value per day; after a null the next value is no change."""
    order = Window.partitionBy(*by).orderBy("us", "arrival_seq")
    changed = F.col("value_num") != F.lag("value_num").over(order)
    marked = readings.withColumn("_c", F.coalesce(changed, F.lit(False)))
    return marked.groupBy(*by, day_of(F.col("us")).alias("day")).agg(F.count_if("_c").alias("n_changes"))


def longest_zero_run(days: DataFrame, *, by: Sequence[str] = ("device_id",), position: str = "day", value: str = "n") -> DataFrame:
    """Length and start of the longest run of zero values, of equal runs the first; length 0 and no start without one."""
    order = Window.partitionBy(*by).orderBy(position)
    island = F.sum(F.when(F.col(value) == 0, 0).otherwise(1)).over(order)
    runs = days.withColumn("_island", island).where(F.col(value) == 0).groupBy(*by, "_island").agg(
        F.count(F.lit(1)).alias("length"), F.min(position).alias("start")
    )
    longest = runs.groupBy(*by).agg(F.max_by(F.struct("length", "start"), F.struct(F.col("length"), -F.col("start"))).alias("r"))
    return days.select(*by).distinct().join(longest, list(by), "left").select(
        *by, F.coalesce("r.length", F.lit(0)).alias("gap_days"), F.col("r.start").alias("gap_start")
    )


def rollup_summary(devices: DataFrame, levels: Sequence[str]) -> DataFrame:
    """One summary row per node of every level, all levels in one pass.

    ``devices`` has the levels, score and severity. ``level`` says how many of the
    levels the row names; a null name within them is a node of its own.
    """
    sets = [[F.col(c) for c in levels[:k]] for k in range(1, len(levels) + 1)]
    named = lambda s: F.count_if(F.col("severity") == s).alias(f"n_{s.lower()}")
    grouped = devices.groupingSets(sets, *map(F.col, levels)).agg(
        F.count(F.lit(1)).alias("n_devices"), F.round(F.avg("score"), 1).alias("avg_score"), F.max("score").alias("max_score"),
        *map(named, ("CRITICAL", "HIGH", "MEDIUM", "HEALTHY")),
        (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int").alias("level"),
    )
    return grouped


def _slope(values: list[float]) -> float | None:
    """The slope of values over their places: running moments in the values' order, each product added with one rounding."""
    mean_x = mean_y = both = spread = 0.0
    for x, y in enumerate(values):
        dx = x - mean_x
        mean_x += dx / (x + 1)
        mean_y += (y - mean_y) / (x + 1)
        both, spread = math.fma(dx, y - mean_y, both), math.fma(dx, x - mean_x, spread)
    return (both / len(values)) / (spread / len(values)) if len(values) > 1 else None


@F.arrow_udf(DoubleType())
def _slopes(values: pa.Array) -> pa.Array:
    return pa.array([_slope(v) for v in values.to_pylist()], pa.float64())


def score_trend(scored: DataFrame, *, least_days: int = 7, by: str = "device_id") -> DataFrame:
    """Slope of the daily score over its row number, first, last, mean and greatest, for devices of enough days.

    ``scored`` has a row per device and day. A slope on the border of a direction falls on a side by its last
    bits: these come from adding up in the order of days, so they depend on neither partitions nor merges.
    """
    rows = scored.withColumn("_y", F.coalesce("score", F.lit(0.0)))
    found = rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_days"), F.sort_array(F.collect_list(F.struct("day", "_y"))).alias("_days"), F.min_by("_y", "day").alias("first_score"),
        F.max_by("_y", "day").alias("last_score"), F.avg("_y").alias("mean_score"), F.max("_y").alias("max_score"),
    )
    long = found.where(F.col("n_days") >= least_days).withColumn("slope", _slopes("_days._y"))
    direction = F.when(F.col("slope") > 0.1, "worsening").when(F.col("slope") < -0.1, "improving").otherwise("stable")
    return long.select(by, "n_days", "slope", "first_score", "last_score", "mean_score", "max_score", direction.alias("direction"))


def key_coverage(readings: DataFrame) -> DataFrame:
    """Devices with a value per key, and their share of all devices of the table."""
    filled = F.col("value_num").isNotNull() | F.col("value_text").isNotNull()
    devices = F.countDistinct(F.when(filled, F.col("device_id")))
    everyone = readings.agg(F.countDistinct("device_id").alias("_all"))  # one row
    counts = readings.groupBy("key").agg(devices.alias("n_devices")).crossJoin(F.broadcast(everyone))
    return counts.withColumn("pct", F.round(F.col("n_devices") * 100.0 / F.col("_all"), 2)).drop("_all")


def stratified(rows: DataFrame, strata: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """``n`` rows taken round-robin from the strata, larger strata first, the best rows of each first."""
    inside = Window.partitionBy(*strata)
    ranked = rows.withColumns({"_turn": F.row_number().over(inside.orderBy(*order)), "_size": F.count(F.lit(1)).over(inside)})
    return ranked.orderBy("_turn", F.col("_size").desc(), *strata).limit(n).drop("_size").withColumnRenamed("_turn", "turn")


def ancestors(edges: DataFrame, *, depth: int = 8) -> DataFrame:
    """(node, ancestor, distance) by walking child-parent ``edges`` upward, each ancestor at its least distance.

    A bounded number of joins; a cycle ends when nothing new is reached.
    """
    step = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    found = step
    up = edges.select(F.col("child").alias("ancestor"), F.col("parent").alias("_next"))
    for d in range(2, depth + 1):
        step = step.join(up, "ancestor").select("node", F.col("_next").alias("ancestor"), F.lit(d).alias("distance"))
        found = found.unionByName(step)
    return found.groupBy("node", "ancestor").agg(F.min("distance").alias("distance"))
