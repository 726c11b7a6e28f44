"""Whitening of embeddings by upper-triangle column aggregates.

Entries become whole numbers, and every dimension is centred at a whole number near its
mean, so products are whole as well. One aggregation sums the products of all pairs of
dimensions, one generated expression a pair of the upper triangle; the part of the mean
that the whole centre leaves is taken off the finished sums, in fractions. The covariance
is therefore that of exact arithmetic (while sums stay below 2^53), whatever the order in
which partitions are merged. LAPACK decomposes it on the driver, where it is one matrix
of dimensions by dimensions; rows are projected by column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries are held within this, so that whole numbers stay exact as doubles.
FARTHEST = float(1 << 42)
#: Expressions of one aggregation. 64 dimensions have 2,080 pairs; wider vectors take a job for each so many pairs.
PAIRS_PER_JOB = 4096


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learns: counts and sums of the fit list, and its leading components."""

    n: int
    sums: list[int]
    values: np.ndarray  # all eigenvalues, falling
    vectors: np.ndarray  # a row for each component kept
    trace: float

    @property
    def means(self) -> list[Fraction]:
        return [Fraction(s, self.n) for s in self.sums]


def usable(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and c, the vector as doubles, of the rows whose vector is neither null nor holds null or non-finite entries."""
    c = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return rows.where(c.isNotNull() & finite).select(F.col(f"`{key}`").alias("vec_id"), c.alias("c"))


def whole(entry: Column) -> Column:
    """floor(1024 * c) + 100000 as long."""
    return F.floor(F.greatest(F.least(entry * SCALE, F.lit(FARTHEST)), F.lit(-FARTHEST))) + SHIFT


def _length(rows: DataFrame) -> int:
    """The commonest number of dimensions, of equally common ones the greatest; 0 without rows."""
    found = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def _columns(fit_list: DataFrame, dimensions: int) -> DataFrame:
    return fit_list.select(*(whole(F.col("c")[k]).alias(f"x{k}") for k in range(dimensions)))


def _exact_sums(fit_list: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    sums = [F.sum(F.col(f"x{k}").cast("decimal(18,0)")).alias(f"s{k}") for k in range(dimensions)]
    row = _columns(fit_list, dimensions).agg(F.count(F.lit(1)).alias("n"), *sums).first()
    return row["n"], [int(row[f"s{k}"]) for k in range(dimensions)] if row["n"] else []


def _product_sums(columns: DataFrame, names: list[str], pairs_per_job: int) -> Iterator[tuple[int, int, float]]:
    """The sum of the product of each pair of columns of doubles, upper triangle."""
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    for start in range(0, len(pairs), pairs_per_job):
        block = pairs[start : start + pairs_per_job]
        (row,) = columns.selectExpr(*(f"sum({names[i]} * {names[j]}) AS p{i}_{j}" for i, j in block)).collect()
        for (i, j), total in zip(block, row):
            yield i, j, total


def covariance(fit_list: DataFrame, n: int, sums: list[int], *, pairs_per_job: int = PAIRS_PER_JOB) -> np.ndarray:
    """The covariance of the whole entries, divisor n."""
    dimensions = len(sums)
    centres = [s // n for s in sums]
    left = [s - n * m for s, m in zip(sums, centres)]  # the sums of the centred entries
    centred = _columns(fit_list, dimensions).select(
        *((F.col(f"x{k}") - F.lit(m)).cast("double").alias(f"u{k}") for k, m in enumerate(centres))
    )
    matrix = np.zeros((dimensions, dimensions))
    for i, j, total in _product_sums(centred, [f"u{k}" for k in range(dimensions)], pairs_per_job):
        matrix[i, j] = matrix[j, i] = float((Fraction(total) - Fraction(left[i] * left[j], n)) / n)
    return matrix


def fit(vectors: DataFrame, *, components: int = COMPONENTS, pairs_per_job: int = PAIRS_PER_JOB) -> tuple[DataFrame, Whitening]:
    """The fit list (vec_id, c) and its whitening, for rows that ``usable`` gives.

    Vectors whose length is not the commonest one are no part of either. Components whose
    eigenvalue is nothing but rounding have no whitening and are left out: of vectors
    that are all equal none is left.
    """
    dimensions = _length(vectors)
    fit_list = vectors.where(F.size("c") == dimensions)
    n, sums = _exact_sums(fit_list, dimensions)
    if not n or not dimensions:
        return fit_list, Whitening(n, sums, np.zeros(0), np.zeros((0, dimensions)), 0.0)
    matrix = covariance(fit_list, n, sums, pairs_per_job=pairs_per_job)
    values, columns = np.linalg.eigh(matrix)
    values, rows = values[::-1], columns.T[::-1]
    # either sign is an eigenvector: the entry of greatest size is positive
    rows = rows * np.sign(rows[np.arange(dimensions), np.abs(rows).argmax(axis=1)])[:, None]
    kept = min(components, int((values > values[0] * dimensions * np.finfo(float).eps).sum())) if values[0] > 0 else 0
    return fit_list, Whitening(n, sums, values, rows[:kept], float(np.trace(matrix)))


def _projections(model: Whitening) -> list[Column]:
    """One number a component: the centred entries times the eigenvector, over the root of its eigenvalue."""
    whole_part = [int(m // 1) for m in model.means]
    rest = [float(m - w) for m, w in zip(model.means, whole_part)]
    x = F.transform("c", whole)
    # the whole part of the mean is taken off in whole numbers, so no digit of x is lost
    centred = F.zip_with(x, F.lit(whole_part).cast("array<bigint>"), lambda a, m: (a - m).cast("double"))
    centred = F.zip_with(centred, F.lit(rest).cast("array<double>"), lambda a, r: a - r)
    out = []
    for value, vector in zip(model.values, model.vectors):
        scaled = F.lit([float(v) for v in vector / np.sqrt(value)]).cast("array<double>")
        out.append(F.aggregate(F.zip_with("u", scaled, lambda a, w: a * w), F.lit(0.0), lambda s, p: s + p))
    return [centred, *out]


def deviation(model: Whitening) -> Column:
    """The sum over dimensions of (n * x - S)^2 as long; null where it does not fit."""
    wide = "decimal(38,0)"
    sums = F.array(*(F.lit(str(s)).cast(wide) for s in model.sums)) if model.sums else F.array().cast(f"array<{wide}>")
    off = F.zip_with(F.transform("c", whole), sums, lambda x, s: (F.lit(model.n).cast("decimal(18,0)") * x.cast("decimal(19,0)") - s).cast(wide))
    total = F.aggregate(off, F.lit(0).cast(wide), lambda t, d: F.try_add(t, F.try_multiply(d, d)).cast(wide))
    return total.try_cast("long")


def whiten(fit_list: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and w, an array of the whitened value of each component."""
    centred, *components = _projections(model)
    empty = F.array().cast("array<double>")
    return fit_list.select("vec_id", deviation(model).alias("deviation"), centred.alias("u")).select(
        "vec_id", "deviation", F.array(*components).alias("w") if components else empty.alias("w")
    )


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of the whitened values' covariance less the identity."""
    if not components:
        return 0.0
    sums = whitened.agg(*(F.sum(F.col("w")[k]).alias(f"s{k}") for k in range(components))).first()
    centred = whitened.select(*((F.col("w")[k] - float(s) / n).alias(f"u{k}") for k, s in enumerate(sums)))
    found = _product_sums(centred, [f"u{k}" for k in range(components)], PAIRS_PER_JOB)
    return max(abs(total / n - (i == j)) for i, j, total in found)


def whitened_rows(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Null ids and repeated rows are rows like any other. Null vectors, vectors with null or
    non-finite entries, and those without the commonest number of dimensions have no rows.
    Entries beyond 2^42 / 1024 in size count as that. Ties between eigenvalues are left to
    LAPACK. Other columns are not read; an empty table gives an empty result.

    What reaches the driver are sums: one row of n + dimensions numbers, and the products
    of ``PAIRS_PER_JOB`` pairs at a time. Nothing is shuffled but these.
    """
    fit_list, model = fit(usable(vectors, key=key, vector=vector), components=components)
    whitened = whiten(fit_list, model)
    error = identity_error(whitened, model.n, len(model.vectors))
    explained = F.lit([float(v / model.trace) for v in model.values[: len(model.vectors)]]).cast("array<double>")
    return whitened.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
