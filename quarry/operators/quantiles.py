"""Exact quantiles and running sums over all rows, without one task that sees all values.

Values are cut into slices at approximate quantiles; sums of whole slices are added as
offsets to running sums inside each. A value's slice depends on nothing but its value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 256


def slice_of(rows: DataFrame, column: str, slices: int = SLICES) -> Column:
    """The slice of a row, rising with its value; fewer than ``slices`` bounds are collected."""
    found = rows.agg(F.percentile_approx(column, [k / slices for k in range(1, slices)]).alias("b")).first()["b"]
    bounds = sorted(set(found or []))
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(column))) if bounds else F.lit(0)


def running_sums(values: DataFrame, by: Sequence[str], column: str, sums: Sequence[str], part: Column) -> DataFrame:
    """Add ``<sum>_upto``, over rows of the group with a value up to this one's, and ``<sum>_all``.

    ``values`` has one row per group and value.
    """
    placed = values.withColumn("_part", part)
    whole = placed.groupBy(*by, "_part").agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(
        *(F.col(c).alias(f"_by_{c}") for c in by), F.col("_part").alias("_p"),
        *(F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}_before") for c in sums),
        *(F.sum(f"_{c}").over(Window.partitionBy(*by)).alias(f"{c}_all") for c in sums),
    )
    # no plain equality, from which the optimizer may infer the slice's own expression for the side that has no values
    same = F.struct("_part") == F.struct("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = Window.partitionBy(*by, "_part").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumns({f"_{c}_in": F.sum(c).over(inside) for c in sums}).join(starts, same)  # a row per group and slice
    return summed.select(
        *values.columns, *((F.col(f"_{c}_before") + F.col(f"_{c}_in")).alias(f"{c}_upto") for c in sums), *(f"{c}_all" for c in sums)
    )


def exact_quantiles(rows: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation; nulls do not count, and without values all are null."""
    known = rows.where(F.col(column).isNotNull())
    values = known.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    placed = running_sums(values, [], column, ["n"], slice_of(known, column))
    wanted = [F.lit(q) * (F.col("n_all") - 1) for q in shares]
    holds = lambda place: (F.col("n_upto") - F.col("n") <= place) & (place < F.col("n_upto"))
    at = lambda place: F.max(F.when(holds(place), F.col(column)))
    found = placed.agg(
        *(F.struct(at(F.floor(w)).alias("low"), at(F.ceil(w)).alias("high"), F.max(w - F.floor(w)).alias("share")).alias(f"q{i}") for i, w in enumerate(wanted))
    ).first()
    return [None if q["low"] is None else float(q["low"] + (q["high"] - q["low"]) * q["share"]) for q in found]
