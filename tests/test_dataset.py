"""The dataset run's statuses and files, quality figures, cross-validation and stored models."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.scalars import HOUR_US
from quarry.operators import boosting, guards, metrics, models, outages, reports, splits, trailing
from quarry.plans import dataset
from quarry.plans.features import KEYS, NOW_US
from quarry.plans.labels import END_US
from quarry.sources.tables import shape

OPTIONS = {"keys": KEYS[:2], "now_us": NOW_US, "end_us": END_US}


@pytest.fixture(scope="module")
def tables(spark, small_tables):
    return shape(spark, small_tables, "raw_telemetry"), shape(spark, small_tables, "evidence")


def test_run_writes_whole_devices_to_splits(spark, tables, tmp_path):
    readings, evidence = tables
    out = str(tmp_path / "out")
    assert dataset.build_dataset(readings, evidence, out, **OPTIONS) is guards.Status.OK
    rows = spark.read.parquet(f"{out}/dataset")
    features = spark.read.parquet(f"{out}/features")
    assert rows.count() == features.count() == rows.select("device_id", "anchor_us").distinct().count()
    pure = rows.where("split <> 'purged'").groupBy("device_id").agg(F.countDistinct("split").alias("n"))
    assert pure.where("n > 1").isEmpty()
    figures = {(r.section, r["name"]): r.value for r in spark.read.json(f"{out}/quality/figures").collect()}
    assert figures["samples", "total"] == rows.count()
    assert figures["samples", "eligible"] == rows.where("eligible").count() > 0
    text = "\n".join(r.value for r in spark.read.text(f"{out}/quality/report").collect())
    assert text.startswith("# Dataset quality") and "## samples" in text and "| total |" in text


def test_status_without_keys_rows_or_verified_outages(tables, tmp_path, monkeypatch):
    readings, evidence = tables
    run = lambda name, r, e, **o: dataset.build_dataset(r, e, str(tmp_path / name), **(OPTIONS | o))
    assert run("a", readings, evidence, keys=[]) is guards.Status.CONFIGURATION
    assert run("b", readings.where("false"), evidence) is guards.Status.NO_USABLE_DATA
    assert run("c", readings, evidence.where("evidence_type <> 'lc_disconnect'")) is guards.Status.NO_VERIFIED_EVIDENCE
    whole = dataset.device_features
    monkeypatch.setattr(dataset, "device_features", lambda *a, **o: whole(*a, **o).withColumn("max_source_us", F.col("anchor_us") + 1))
    assert run("d", readings, evidence) is guards.Status.LEAKAGE
    assert not (tmp_path / "d" / "dataset").exists()


def test_prohibited_columns_are_not_written(tables, tmp_path, monkeypatch):
    readings, evidence = tables
    whole = dataset.device_features
    monkeypatch.setattr(dataset, "device_features", lambda *a, **o: whole(*a, **o).withColumn("view__risk_score", F.lit(1)))
    assert dataset.build_dataset(readings, evidence, str(tmp_path / "p"), **OPTIONS) is guards.Status.CONFIGURATION
    assert not (tmp_path / "p" / "dataset").exists()


def test_negatives_need_a_source_that_covers_them(spark, tables, tmp_path):
    """One device covered to the end, one whose source ended early, the others without a record."""
    readings, evidence = tables
    one, two = sorted(r.device_id for r in evidence.select("device_id").distinct().collect())[:2]
    ledger = spark.createDataFrame([(one, "complete", END_US), (two, "complete", END_US - 3 * 24 * HOUR_US), (two, "failed", END_US)], "device_id string, completeness string, newest_us long")
    out = str(tmp_path / "gated")
    assert dataset.build_dataset(readings, evidence, out, **OPTIONS, ledger=ledger, coverage_days=2) is guards.Status.OK
    rows = spark.read.parquet(f"{out}/dataset")
    negatives = {r.device_id for r in rows.where("y = 0").select("device_id").distinct().collect()}
    assert negatives <= {one}
    stale = rows.where("censor_reason = 'label_source_history_stale'").select("device_id").distinct().collect()
    assert {r.device_id for r in stale} == {two}
    nowhere = rows.where("censor_reason = 'no_label_source_coverage_for_device'").select("device_id").distinct().collect()
    assert nowhere and not {r.device_id for r in nowhere} & {one, two}
    assert rows.where("y = 1 AND device_id NOT IN ('%s', '%s')" % (one, two)).count() > 0  # a seen outage is proof by itself


def test_quality_figures_of_empty_tables_are_zero(spark):
    samples = spark.createDataFrame([], "device_id string, anchor_us long, split string, y int, label_status string, censor_reason string, n_rows long, last_age_h double")
    evidence = spark.createDataFrame([], "device_id string, us long, observed_us long, evidence_type string, evidence_strength string")
    windows = spark.createDataFrame([], "window_closed boolean")
    readings = spark.createDataFrame([], "device_id string, key string")
    found = reports.quality_metrics(outages.eligibility(samples), evidence, windows, readings).collect()
    assert {r.section for r in found} == {"samples", "evidence", "outage_windows"}
    assert all(r.value == 0 for r in found)


def _separable(spark):
    rows = [(f"d{d}", d * HOUR_US + t * 30 * HOUR_US, int((d + t) % 3 == 0), float((d + t) % 3), 1.0) for d in range(6) for t in range(20)]
    return spark.createDataFrame(rows, "device_id string, anchor_us long, y int, a double, same double").coalesce(1)


def test_folds_cover_all_rows_once_and_rank_a_clear_label(spark, tmp_path):
    rows = _separable(spark)
    found = models.cross_validate(rows, ["a", "same"], str(tmp_path / "cv"), folds=2, trees=2, depth=2)
    by_group = found.where("kind = 'group'")
    assert by_group.count() == rows.count() == by_group.select("device_id", "anchor_us").distinct().count()
    assert by_group.groupBy("device_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    report = {(r.kind, r.fold): r for r in models.fold_report(found).collect()}
    assert report["pooled", -1].n == rows.count() and report["pooled", -1].roc_auc == pytest.approx(1.0)
    assert {k for k, _ in report} == {"group", "time", "pooled"}
    nothing = models.cross_validate(rows.withColumn("y", F.lit(0)), ["a"], str(tmp_path / "none"), folds=2)
    assert nothing.count() == 0


def test_rows_are_placed_in_folds_once_and_no_fold_is_one_task(spark, tmp_path, monkeypatch):
    rows, plans, fit = _separable(spark), [], models.fit
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(models, "fit", lambda train, *a, **k: plans.append(plan(train)) or fit(train, *a, **k))
    models.cross_validate(rows, ["a"], str(tmp_path / "cv"), folds=2, trees=1, depth=1)
    assert plans and not any("Join" in p or "Generate" in p for p in plans)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning(fold" not in plan(metrics.time_folds(rows, gap_us=HOUR_US, label="y")).split("BroadcastExchange")[0]
        assert "SortMergeJoin" not in plan(metrics.time_folds(rows, gap_us=HOUR_US, label="y"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _mixed(spark, days=40):
    """Rows of which values decide the label in part; nulls, a column that is constant where a fold is trained, and one without values."""
    rows = spark.range(0, 12 * days, 1, 3).selectExpr("CAST(id % 12 AS STRING) AS device_id", f"(id DIV 12) * {6 * HOUR_US} AS anchor_us", "id", "pmod(xxhash64(id), 100) AS h")
    rows = rows.selectExpr("device_id", "anchor_us", "h", "CASE WHEN h % 5 > 0 THEN CAST(h % 17 AS DOUBLE) END AS a", "CAST(pmod(xxhash64(id, 1), 9) AS DOUBLE) AS b", f"CASE WHEN anchor_us >= {24 * days // 8 * 6 * HOUR_US} THEN 2.0D ELSE 1.0D END AS late", "CAST(NULL AS DOUBLE) AS none")
    return rows.withColumn("y", F.expr("CASE WHEN coalesce(a, 12) + b / 2 + h % 3 > 13 THEN 1 ELSE 0 END")).drop("h")


def test_folds_fitted_together_predict_as_each_fold_by_itself(spark, tmp_path, monkeypatch):
    """One fit serves all folds, and its trees are those that Spark's learner finds for a fold on its rows alone."""
    rows, columns, calls, fit = _mixed(spark), ["a", "b", "late", "none"], [], models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **k: calls.append(1) or fit(*a, **k))
    found = models.cross_validate(rows, columns, str(tmp_path / "cv"), folds=3, gap_us=12 * HOUR_US, trees=4, depth=3)
    assert len(calls) == 1
    placed = rows.join(splits.group_folds(rows, "device_id", 3), "device_id")
    by_time = metrics.time_folds(rows, gap_us=12 * HOUR_US, label="y")
    alone = [("group", k, placed.where(F.col("fold") != k), placed.where(F.col("fold") == k)) for k in range(3)]
    alone += [("time", k, by_time.where((F.col("fold") == k) & (F.col("side") == "train")), by_time.where((F.col("fold") == k) & (F.col("side") == "test"))) for k in range(3)]
    for kind, k, train, test in alone:
        used = [c for c in columns if c not in metrics.constant_columns(train, columns)]
        expected = {(r.device_id, r.anchor_us): r.probability for r in models.predict(fit(train, used, trees=4, depth=3), test, used).collect()}
        here = {(r.device_id, r.anchor_us): r.probability for r in found.where((F.col("kind") == kind) & (F.col("fold") == k)).collect()}
        assert len(set(expected.values())) > 4 and here.keys() == expected.keys()
        assert max(abs(here[i] - expected[i]) for i in here) <= 2e-6


def test_of_splits_that_part_the_same_rows_the_first_column_is_asked():
    """A column and its mirror image have the same gains but for rounding."""
    rng = np.random.default_rng(1)
    by = boosting.Coding([np.arange(4.0)] * 2, [[np.arange(4)] * 2], [[True, True]], [(977, 61)])
    for _ in range(200):
        one = np.concatenate([np.zeros((2, 2, 1)), rng.integers(1, 99, (2, 2, 5)) * np.array([1, boosting.UNIT * 1_234_567])[:, None, None]], axis=2)
        both = np.stack([one, np.concatenate([one[..., :1], one[..., :0:-1]], axis=2)], axis=2)
        assert boosting._best(both, by, 0)[0] == 0


def test_thresholds_are_those_of_the_learner_where_values_are_many(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 2).selectExpr("CAST(pmod(xxhash64(id), 1000) AS DOUBLE) / 8 AS a", "CAST(id % 2 AS INT) AS y").withColumn("y", F.expr("CASE WHEN a > 70 OR a % 7 < 1 THEN 1 ELSE 0 END"))
    model = models.fit(rows, ["a"], trees=6, depth=4)
    asked = {float(x) for t in model.stages[1].trees for x in re.findall(r"feature 0 <= ([\d.]+)", t.toDebugString)}
    values = rows.toPandas()
    ones = values.y.sum()
    weights = np.where(values.y == 1, len(values) / (2 * ones), len(values) / (2 * (len(values) - ones)))
    found = boosting.thresholds(values.a.to_numpy(), weights, boosting.BINS)
    assert len(found) == boosting.BINS - 1
    assert asked and all(np.abs(found - x).min() < 1e-9 for x in asked)


def test_a_stored_model_scores_alike_and_fills_absent_columns(spark, tmp_path):
    rows, path = _separable(spark), str(tmp_path / "model")
    model = models.fit(rows, ["a", "same"], trees=2, depth=2)
    models.save(model, ["a", "same"], path)
    loaded, columns = models.load(spark, path)
    assert columns == ["a", "same"]
    take = lambda m: [r.probability for r in models.predict(m, rows, columns).orderBy("device_id", "anchor_us").collect()]
    assert take(loaded) == take(model)
    assert models.predict(loaded, rows.drop("a"), columns).select("probability").distinct().count() == 1
    with pytest.raises(ValueError):
        models.save(model, ["same", "a"], path)


def test_late_sources_raise(spark):
    df = spark.createDataFrame([(1, 2)], "anchor_us long, max_source_us long")
    with pytest.raises(trailing.LeakageError):
        trailing.require_no_leakage(df, source="max_source_us")


def test_a_fit_keeps_its_rows_in_parts_of_bounded_size(spark, monkeypatch):
    """Rows that lie in one file are dealt by what their inputs take, and small ones are left where they are."""
    rows = spark.range(0, 2000, 1, 1).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b", "CAST(id % 2 AS INT) AS y")
    parts, prepared = [], models.prepared
    monkeypatch.setattr(models, "prepared", lambda rows, columns: parts.append([sum(1 for _ in p) for p in rows.rdd.glom().collect()]) or prepared(rows, columns))
    models.fit(rows, ["a", "b"], trees=1, depth=1)
    monkeypatch.setattr(models, "PART_BYTES", 10_000)
    models.fit(rows, ["a", "b"], trees=1, depth=1)
    small, large = parts
    assert small == [2000]
    assert sum(large) == 2000 and len(large) == 13 and max(large) * 4 * 16 < 1.2 * 10_000
