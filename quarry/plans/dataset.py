"""The run from readings and evidence to a written dataset, its quality figures, and cross-validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import HOUR_US, is_fault_word, severity
from quarry.functions.vocabulary import FAULT, MISSING
from quarry.operators import grid, guards, hierarchy, models, outages, outputs, quality, reports, splits, trailing
from quarry.sources.tables import shape, sql
from quarry.streaming import runs

from .features import _JUDGED, KEYS, NOW_US, STEP_US, device_features
from .labels import _SAMPLES, _WINDOWS, END_US, _labels_sql, _windows, lbl_samples
from .registry import query


def build_dataset(
    readings: DataFrame, evidence: DataFrame, out: str, *, keys: Sequence[str], now_us: int, end_us: int, ledger: DataFrame | None = None,
    coverage_days: float = 7, hours: Sequence[int] = (24,), purge_hours: float = 24,
) -> guards.Status:
    """Write ``features``, ``dataset`` (a folder per split) and ``quality`` below ``out``, and say how the run ended.

    ``readings`` are raw; records in quarantine are left out. Devices are split as wholes,
    in order of their median anchor. With a ``ledger`` of label sources (device_id, completeness,
    newest_us) negatives of devices that no source covers, or whose newest record is older
    than ``coverage_days`` at the end, are censored; without one the span of a device's evidence
    decides. Nothing is written to ``dataset`` when the features leak, or when one is
    prohibited as an output.
    """
    spark = readings.sparkSession
    if not keys:
        return guards.Status.CONFIGURATION
    clean = quality.quarantine(readings, now_us).where("reason IS NULL")
    outputs.write_parquet(device_features(clean, list(keys), hours=list(hours)), f"{out}/features")
    features = spark.read.parquet(f"{out}/features")
    try:
        trailing.require_no_leakage(features, source="max_source_us")
        quality.guard_columns(features)  # the label's own columns come later
    except trailing.LeakageError:
        return guards.Status.LEAKAGE
    except quality.PolicyError:
        return guards.Status.CONFIGURATION
    if features.isEmpty():
        return guards.Status.NO_USABLE_DATA
    placed = splits.group_splits(features, "device_id").select("device_id", "split")
    samples = splits.purge(features.select("device_id", "anchor_us").join(placed, "device_id"), purge_hours)
    strong = evidence.where("evidence_strength = 'strong'")
    kind = F.col("evidence_type")
    outputs.write_parquet(outages.outage_windows(strong, kind == "lc_disconnect", kind == "lc_connect"), f"{out}/windows")
    windows = spark.read.parquet(f"{out}/windows")
    verdicts = None if ledger is None else outages.coverage_verdicts(ledger, end_us, coverage_days)
    labelled = outages.label_samples(samples, windows, outages.evidence_spans(evidence), end_us, verdicts=verdicts)
    joined = labelled.join(features, ["device_id", "anchor_us"])
    judged = outages.eligibility(joined.withColumns({"n_rows": F.col("g__n_rows_total"), "last_age_h": F.col("g__last_age_h")}))
    outputs.write_parquet(judged, f"{out}/dataset", by=["split"])
    dataset = spark.read.parquet(f"{out}/dataset")
    figures = reports.quality_metrics(dataset, evidence, windows, clean)
    reports.write_report(reports.markdown("Dataset quality", figures), figures, f"{out}/quality")
    return guards.dataset_status(windows, dataset)


def _dataset(spark: SparkSession, sf_dir: str) -> tuple[guards.Status, str]:
    out = runs.scratch(spark, "dataset")
    evidence, ledger = shape(spark, sf_dir, "evidence"), shape(spark, sf_dir, "ledger")
    readings = shape(spark, sf_dir, "raw_telemetry")
    return build_dataset(readings, evidence, out, keys=KEYS, now_us=NOW_US, end_us=END_US, ledger=ledger, coverage_days=2), out


#: The run's samples as the labels' oracle has its own: anchors of good readings, devices split as wholes, borders purged.
_RUN_SAMPLES = f"""{_JUDGED.replace("judged AS", "sorted_out AS")}, clean AS (SELECT * FROM sorted_out WHERE reason IS NULL),
  ends AS (SELECT max(us) AS end_us FROM clean), starts AS (SELECT device_id, min(us) AS start_us FROM clean GROUP BY 1),
  anchors AS (SELECT device_id, unnest(generate_series(CAST(ceil(start_us::DOUBLE / {STEP_US}) AS BIGINT) * {STEP_US}, end_us, {STEP_US})) AS anchor_us FROM starts, ends),
  g AS (SELECT device_id, median(anchor_us) AS median_us, count(*) AS n FROM anchors GROUP BY 1),
  u AS (SELECT *, row_number() OVER w AS k, sum(n) OVER w AS upto, sum(n) OVER () AS total, count(*) OVER () AS groups FROM g WINDOW w AS (ORDER BY median_us, device_id)),
  cut AS (SELECT a.k AS c1, b.k AS c2 FROM u a JOIN u b ON a.k < b.k AND b.k < b.groups
    ORDER BY round(abs(a.upto - 0.7E0 * a.total) + abs(b.upto - a.upto - 0.15E0 * a.total) + abs(a.total - b.upto - 0.15E0 * a.total), 6), 1, 2 LIMIT 1),
  rows_ AS (SELECT a.*, CASE WHEN k <= c1 THEN 'train' WHEN k <= c2 THEN 'validation' ELSE 'test' END AS split FROM anchors a JOIN u USING (device_id), cut),
  borders AS (SELECT (max(anchor_us) FILTER (split = 'train') + min(anchor_us) FILTER (split = 'validation')) / 2.0E0 AS b1,
    (max(anchor_us) FILTER (split = 'validation') + min(anchor_us) FILTER (split = 'test')) / 2.0E0 AS b2 FROM rows_),
  tagged AS (SELECT device_id, anchor_us, CASE WHEN split = 'train' AND anchor_us > b1 - {24 * HOUR_US} OR split = 'validation' AND anchor_us < b1 + {24 * HOUR_US}
    OR split = 'validation' AND anchor_us > b2 - {24 * HOUR_US} OR split = 'test' AND anchor_us < b2 + {24 * HOUR_US} THEN 'purged' ELSE split END AS split FROM rows_, borders)"""


@query(f"""WITH {_labels_sql(True).replace(_SAMPLES, _RUN_SAMPLES)},
  ages AS (SELECT f.*, (f.anchor_us - (SELECT max(us) FROM clean c WHERE c.device_id = f.device_id AND c.us <= f.anchor_us AND c.value_num IS NOT NULL)) / {float(HOUR_US)} AS age_h FROM final f)
  SELECT split, label_status, censor_reason, label_status = 'measured' AND split <> 'purged' AND coalesce(age_h <= 24, false) AS eligible,
    count(*) AS n, count(DISTINCT device_id) AS n_devices, 0 AS status FROM ages GROUP BY ALL""")
def cli_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written dataset's rows by split, label and eligibility, with the run's status."""
    status, out = _dataset(spark, sf_dir)
    rows = spark.read.parquet(f"{out}/dataset").groupBy("split", "label_status", "censor_reason", "eligible")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("device_id").alias("n_devices")).withColumn("status", F.lit(int(status)))


_AGE = "CASE WHEN anchor_us % 11 = 0 THEN NULL ELSE CAST(floor(anchor_us / {hour}) AS BIGINT) % 30 END".replace("{hour}", f"{HOUR_US}.0E0")


def _figures_sql() -> str:
    one = lambda section, pairs, source: " UNION ALL ".join(f"SELECT '{section}', '{n}', CAST({e} AS DOUBLE) FROM {source}" for n, e in pairs.items())
    spread = lambda section, column, source, shares: one(section, {n: f"quantile_cont({column}, {q})" for n, q in (*shares, ("max", 1.0))}, source)
    samples = {
        "total": "count(*)", "eligible": "count_if(ok)", "excluded": "count_if(NOT ok)", "anomaly_eligible": "count_if(n_rows > 0 AND split <> 'purged')",
        "label_measured": "count_if(label_status = 'measured')", "label_censored": "count_if(label_status = 'censored')",
        "positive_labels": "count(*) FILTER (y = 1)", "devices": "count(DISTINCT device_id)",
    }
    who = {"rows": "sum(n)", "devices_with_strong_evidence": "count_if(s > 0)", "weak_only_devices": "count_if(w > 0 AND s = 0)", "weak_evidence_rows": "sum(w)"}
    parts = [
        one("samples", samples, "looked_at"),
        "SELECT 'censor_reasons', censor_reason, CAST(count(*) AS DOUBLE) FROM looked_at GROUP BY 2",
        spread("freshness_hours", "last_age_h", "looked_at", [("p50", 0.5), ("p90", 0.9), ("p99", 0.99)]),
        *(f"SELECT 'split_balance_by_device', split || '.{n}', CAST({e} AS DOUBLE) FROM sizes GROUP BY split" for n, e in {"count": "count(*)", "min": "min(n)", "max": "max(n)", "mean": "avg(n)"}.items()),
        one("evidence", who, "each_"),
        "SELECT 'evidence_by_type', evidence_type, CAST(count(*) AS DOUBLE) FROM evidence GROUP BY 2",
        "SELECT 'evidence_by_strength', evidence_strength, CAST(count(*) AS DOUBLE) FROM evidence GROUP BY 2",
        one("outage_windows", {"total": "count(*)", "closed": "count_if(window_closed)"}, "windows"),
        spread("observed_minus_evidence_seconds", "delay_s", "delays", [("p50", 0.5), ("p90", 0.9)]),
        "SELECT * FROM (SELECT 'coverage_by_key', key, CAST(count(*) AS DOUBLE) FROM telemetry GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 50)",
    ]
    body = " UNION ALL ".join(parts)
    return f"""WITH {_labels_sql(True)}, aged AS (SELECT *, anchor_us % 7 AS n_rows, {_AGE} AS last_age_h FROM final),
  looked_at AS (SELECT *, n_rows > 0 AND label_status = 'measured' AND split <> 'purged' AND coalesce(last_age_h <= 24, false) AS ok FROM aged),
  sizes AS (SELECT split, device_id, count(*) AS n FROM looked_at GROUP BY ALL), delays AS (SELECT (arrival_seq % 1000) * 0.25E0 AS delay_s FROM evidence),
  each_ AS (SELECT device_id, count(*) AS n, count_if(evidence_strength = 'strong') AS s, count_if(evidence_strength = 'weak') AS w FROM evidence GROUP BY 1),
  figures(section, name, value) AS ({body}) SELECT section, name, round(value, 6) AS value FROM figures"""


@query(_figures_sql())
def agg_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quality figures of the labelled samples, written once and reread for every section."""
    path = runs.scratch(spark, "judged")
    aged = lbl_samples(spark, sf_dir).withColumns({"n_rows": F.col("anchor_us") % 7, "last_age_h": F.expr(_AGE)})
    outputs.write_parquet(outages.eligibility(aged), path)
    evidence = shape(spark, sf_dir, "evidence").withColumn("observed_us", F.col("us") + (F.col("arrival_seq") % 1000) * 250_000)
    found = reports.quality_metrics(spark.read.parquet(path), evidence, _windows(spark, sf_dir), shape(spark, sf_dir, "telemetry"))
    return found.withColumn("value", F.round("value", 6))


@query()
def ml_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and time folds over features of two keys; the label is an error in the step of the grid after the anchor."""
    path = runs.scratch(spark, "cv")
    readings = shape(spark, sf_dir, "telemetry")
    before = F.col("us") - 1
    ahead = readings.where("key = 'error'").select("device_id", (before - before % STEP_US).alias("anchor_us")).distinct().withColumn("y", F.lit(1))
    wide = device_features(readings, ["view", "click"], text_keys=[], hours=[24], beside=ahead)
    columns = [c for c in wide.columns if "__" in c and not c.startswith("g__")]
    outputs.write_parquet(wide.select("device_id", "anchor_us", F.coalesce("y", F.lit(0)).alias("y"), *columns), f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    return models.fold_report(models.cross_validate(rows, columns, f"{path}/folds", trees=5, depth=3))


#: the six levels of the estate: bank, head office, region, zone, regional office, branch
LEVELS = {
    "bank": ["bank"], "head_office": ["bank", "customer_id"], "region": ["bank", "zone"], "zone": ["bank", "zone", "branch"],
    "office": ["bank", "branch", "type"], "branch": ["bank", "zone", "branch", "type"],
}
GAP_FAULT_DAYS = 3  # fixed value: days without use from which a device counts as faulty
_ESTATE = """SELECT bank, customer_id, zone, branch, type, CAST(k % 101 AS DOUBLE) AS score, k % 12 AS gap_days, (k % 9) * 0.5E0 AS total_data_mb,
  k * 37 % 2000 AS bas_downtime_min, k * 11 % 700 AS nvr_downtime_min, k % 90 AS fas_downtime_min, k % 61 AS ias_downtime_min, k % 8 AS camera_disconnects,
  CASE WHEN k % 5 = 0 THEN 'model' WHEN k % 5 = 1 THEN '' END AS recorder_model, CASE WHEN k % 3 = 0 THEN '10.0.0.1' ELSE '' END AS private_ip,
  CASE k % 7 WHEN 0 THEN 'FAULT' WHEN 1 THEN 'N/A' WHEN 2 THEN 'ok' END AS integrated_status FROM (SELECT *, CAST(device_id AS BIGINT) AS k FROM {devices})"""


def _levels_sql() -> str:
    columns = ["bank", "customer_id", "zone", "branch", "type"]
    faults = ", ".join(f"'{w}'" for w in FAULT if w.lower() not in MISSING)
    sums = ", ".join(f"round(sum({k}_downtime_min) / 60, 1) AS {k}_down_hrs" for k in ("bas", "nvr", "fas", "ias"))
    stats = f"""count(*) AS n_devices, round(avg(score), 1) AS avg_score, max(score) AS max_score, count(*) FILTER (score >= 70) AS n_critical, count(*) FILTER (score >= 45 AND score < 70) AS n_high,
      count(*) FILTER (score >= 20 AND score < 45) AS n_medium, count(*) FILTER (score < 20) AS n_healthy, count(*) FILTER (gap_days >= {GAP_FAULT_DAYS}) AS gap_devices, max(gap_days) AS max_gap_days, sum(total_data_mb) AS total_data_mb,
      {sums}, CAST(sum(camera_disconnects) AS BIGINT) AS cam_dc_total, count(*) FILTER (recorder_model <> '') AS recorder_devices, count(*) FILTER (private_ip <> '') AS tunnel_devices, count(*) FILTER (upper(trim(integrated_status)) IN ({faults})) AS integrated_faults"""
    each = (f"SELECT {', '.join(c if c in cs else f'NULL AS {c}' for c in columns)}, '{name}' AS level, {stats} FROM estate GROUP BY {', '.join(cs)}" for name, cs in LEVELS.items())
    return f"WITH estate AS ({_ESTATE.replace('{devices}', 'devices')}) " + " UNION ALL ".join(each)


@query(_levels_sql())
def agg_hier_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    estate = sql(spark, sf_dir, _ESTATE).withColumn("severity", severity(F.col("score")))
    present = {"recorder_devices": F.col("recorder_model"), "tunnel_devices": F.col("private_ip")}
    return hierarchy.level_summaries(estate, LEVELS, gap_fault_days=GAP_FAULT_DAYS, present=present, fault=is_fault_word(F.col("integrated_status")))


_MONTHS = """s AS (SELECT bank, strftime(make_timestamp(anchor_us), '%Y-%m') AS month, device_id, anchor_us, probability, arrival_seq FROM scored JOIN devices USING (device_id) WHERE probability >= 0.5)"""


def _critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    banks = shape(spark, sf_dir, "devices").select("device_id", "bank")
    rows = shape(spark, sf_dir, "scored").where("probability >= 0.5").join(banks, "device_id")
    month = F.date_format(F.timestamp_micros("anchor_us").cast("timestamp_ntz"), "yyyy-MM")
    return rows.select("bank", month.alias("month"), "device_id", "anchor_us", "probability", "arrival_seq")


@query(f"WITH {_MONTHS} SELECT * FROM s ORDER BY bank, month, probability DESC, device_id, anchor_us, arrival_seq")
def srt_review_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _critical(spark, sf_dir).orderBy("bank", "month", F.col("probability").desc(), "device_id", "anchor_us", "arrival_seq")


@query(f"""WITH {_MONTHS}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY bank, month ORDER BY probability DESC, device_id, anchor_us, arrival_seq) AS INTEGER) AS turn, count(*) OVER (PARTITION BY bank, month) AS n FROM s)
  SELECT bank, month, device_id, anchor_us, probability, arrival_seq, turn FROM r ORDER BY turn, n DESC, bank, month LIMIT 100""")
def top_stratified_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = [F.col("probability").desc(), F.col("device_id"), F.col("anchor_us"), F.col("arrival_seq")]
    return grid.stratified(_critical(spark, sf_dir), ["bank", "month"], best, 100)
