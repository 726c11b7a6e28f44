"""Boosted trees on wide features: fit, score and tiers."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import tier
from quarry.operators import boosting, metrics, outputs, quantiles, splits
from quarry.operators.boosting import SENTINEL

#: What a task of a fit keeps of the rows, twice eight bytes for each input: the values and what the trees make of them.
PART_BYTES = 64 << 20
RATE = 0.06


def prepared(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns without nulls, and an indicator for each; absent columns count as null."""
    have = [c for c in columns if c in rows.columns]
    filled = {f"{c}__x": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(SENTINEL)) for c in have}
    filled |= {f"{c}__x": F.lit(SENTINEL) for c in columns if c not in have}
    missing = {f"{c}__na": F.col(c).isNull().cast("double") if c in have else F.lit(1.0) for c in columns}
    return rows.withColumns(filled | missing)


def dealt(rows: DataFrame, total: int, inputs: int) -> DataFrame:
    """``rows`` in even parts of ``PART_BYTES`` as a fit keeps them; files that compress well would give it few and large ones."""
    parts = -(-total * inputs * 16 // PART_BYTES)
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else rows


def fit(
    rows: DataFrame, columns: Sequence[str], label: str = "y", *, trees: int = 20, depth: int = 4, rate: float = RATE, seed: int = 7, together: boosting.Coding | None = None
) -> PipelineModel | list[list[boosting.Tree]]:
    """Gradient-boosted trees with both classes weighted alike.

    With a coding ``together``, rows are its cells, and ``columns`` count a cell's rows in the
    training rows of several folds: each fold's trees, the same kind of trees fitted in common passes.
    """
    if together:
        return boosting.fit(rows, together, label, columns, trees=trees, depth=depth, rate=rate)
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}  # two rows
    total = sum(counts.values())
    weight = F.when(F.col(label) == 1, total / (2 * max(1, counts.get(1, 0)))).otherwise(total / (2 * max(1, counts.get(0, 0))))
    inputs = [f"{c}__{k}" for c in columns for k in ("x", "na")]
    trees_ = GBTClassifier(labelCol=label, featuresCol="_features", weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_features"), trees_]).fit(prepared(dealt(rows, total, len(inputs)), columns).withColumn("_weight", weight))


def predict(model: PipelineModel, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with probability, risk_score (0 to 100, half-even) and tier."""
    scored = model.transform(prepared(rows, columns).withColumn("_weight", F.lit(1.0)))
    p = F.bround(vector_to_array("probability")[1], 6)
    return scored.withColumn("_p", p).select(
        *rows.columns, F.col("_p").alias("probability"), F.bround(F.col("_p") * 100, 1).alias("risk_score"), tier(F.col("_p")).alias("tier")
    )


def save(model: PipelineModel, columns: Sequence[str], path: str) -> None:
    """The fitted model and the names of its columns, in their order."""
    model.write().overwrite().save(f"{path}/model")
    listed = model.stages[0].getInputCols()
    if listed != [f"{c}__{k}" for c in columns for k in ("x", "na")]:
        raise ValueError("the model was fitted on other columns")
    SparkSession.active().createDataFrame(list(enumerate(columns)), "place int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    names = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
    return PipelineModel.load(f"{path}/model"), [r["name"] for r in names]


def _written(rows: DataFrame, path: str) -> DataFrame:
    outputs.write_parquet(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _constant(rows: DataFrame, columns: Sequence[str], train: Sequence[Column], sample: pa.Table) -> list[list[bool]]:
    """Of each fold which columns are constant among its training rows; only what the sample leaves open is sought among all rows."""
    here = [np.asarray(sample[f"_train{m}"]) for m in range(len(train))]
    open_ = [(m, c) for m in range(len(train)) for c in columns if len(pc.unique(sample[c].filter(pa.array(here[m])).drop_null())) < 2]
    if not open_:
        return [[False for _ in columns] for _ in train]
    of = lambda m, c: F.when(train[m], F.col(c))
    valued = functools.reduce(Column.__or__, (F.col(c).isNotNull() for c in sorted({c for _, c in open_})))
    row = rows.where(valued).agg(*((F.min(of(m, c)) != F.max(of(m, c))).alias(f"{m} {c}") for m, c in open_)).first()
    constant = {(m, c) for m, c in open_ if not row[f"{m} {c}"]}
    return [[(m, c) in constant for c in columns] for m in range(len(train))]


def cross_validate(
    rows: DataFrame, columns: Sequence[str], path: str, *, group: str = "device_id", time: str = "anchor_us", folds: int = 5, gap_us: int = 86_400_000_000, trees: int = 20, depth: int = 4
) -> DataFrame:
    """Predictions (``rows``' id columns, y, probability, ``kind``, ``fold``), written below ``path`` and reread.

    ``group`` folds keep a group on one side; ``time`` folds train before a cut and test
    after it and a gap. Folds without a positive on either side are left out, and columns
    that are constant among a fold's training rows are no inputs of its model.
    All folds are fitted together on cells (``boosting``); coded rows, placed in folds, and cells are written once beside ``path``.
    """
    ids = [c for c in rows.columns if c not in columns]
    spark, schema = rows.sparkSession, rows.select(*ids, F.lit(0.0).alias("probability"), F.lit("").alias("kind"), F.lit(0).alias("fold")).schema
    placed = _written(splits.group_folds(rows, group, folds), f"{path}-groups")
    bounds = quantiles.exact_quantiles(rows, time, metrics.TIME_CUTS)
    sides = [] if None in bounds else metrics.fold_sides(bounds, gap_us, time)
    fold = F.col("fold")
    jobs = [("group", k, fold != k, fold == k) for k in range(folds)] + [("time", k, F.col(f"_side{k}") == "train", F.col(f"_side{k}") == "test") for k in range(len(sides))]
    # rows of one group, label and sides are counted first, so few are joined
    tally = rows.withColumns({f"_side{k}": s for k, s in enumerate(sides)}).groupBy(group, "y", *(f"_side{k}" for k in range(len(sides)))).agg(F.count(F.lit(1)).alias("_n"))
    n = lambda side, y: F.coalesce(F.sum(F.when(side & (F.col("y") == y), F.col("_n"))), F.lit(0))
    counts = tally.join(placed, group, "left").agg(F.struct(F.coalesce(F.sum("_n"), F.lit(0))), *(F.struct(n(train, 0), n(train, 1), n(test, 1)) for _, _, train, test in jobs)).first()
    jobs, classes = [j for j, c in zip(jobs, counts[1:]) if all(c)], [(c[0], c[1]) for c in counts[1:] if all(c)]
    if jobs:
        train, named = [j[2] for j in jobs], [f"_train{m}" for m in range(len(jobs))]
        with_sides = lambda df: df.join(placed, group, "left").withColumns({f"_side{k}": s for k, s in enumerate(sides)})
        told = {name: F.coalesce(t, F.lit(False)) for name, t in zip(named, train)}
        share = -(-boosting.SAMPLE * (1 << 30) // counts[0][0])
        some = rows.where(F.pmod(F.xxhash64(*ids), F.lit(1 << 30)) < share)
        sample = with_sides(some).withColumns(told).select("y", *named, *(F.col(c).cast("double").alias(c) for c in columns)).toArrow()
        constant = _constant(with_sides(rows.select(*ids, *columns)), columns, train, sample)
        kept = [m for m in range(len(jobs)) if not all(constant[m])]
        jobs, named, classes = ([x[m] for m in kept] for x in (jobs, named, classes))
    if not jobs:
        return _written(spark.createDataFrame([], schema), path)
    by = boosting.coding(sample, columns, named, "y", [[not c for c in constant[m]] for m in kept], classes)
    coded = _written(boosting.coded(rows, columns, by).join(placed, group, "left").select(*ids, "fold", "codes"), f"{path}-coded")
    known = coded.withColumns({f"_side{k}": s for k, s in enumerate(sides)})
    cells = known.groupBy("codes", "y").agg(*(F.count_if(j[2]).alias(name) for j, name in zip(jobs, named)))
    cells = _written(cells.where(functools.reduce(Column.__or__, (F.col(name) > 0 for name in named))), f"{path}-cells")
    models = fit(cells, named, trees=trees, depth=depth, together=by)
    tests = known.select(*ids, "codes", F.explode(F.array_compact(F.array(*(F.when(j[3], F.lit(m)) for m, j in enumerate(jobs))))).alias("model"))
    found = boosting.score(tests, by, models, RATE)
    of = lambda part: F.get(F.array(*(F.lit(j[part]) for j in jobs)), F.col("model"))
    return _written(found.select(*ids, F.bround("probability", 6).alias("probability"), of(0).alias("kind"), of(1).alias("fold")), path)


def fold_report(predictions: DataFrame) -> DataFrame:
    """Rows, positives and ranking metrics of each fold, and of all group folds together as fold -1."""
    pooled = predictions.where("kind = 'group'").withColumns({"kind": F.lit("pooled"), "fold": F.lit(-1)})
    both = predictions.unionByName(pooled)
    counts = both.groupBy("kind", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))
    return metrics.ranking_metrics(both, by=("kind", "fold")).join(counts, ["kind", "fold"])
