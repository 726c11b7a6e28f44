"""Queries on streams and models, each run to the end of the synthetic events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import chain, models, outages, quality
from quarry.sources.tables import _SPARK_US, shape
from quarry.streaming import runs, snapshots, stateful

from .features import NOW_US, device_features
from .registry import query

US = _SPARK_US.replace(r"\1", "ts")


@query("""WITH marks AS (SELECT device_id, us, arrival_seq, evidence_type = 'lc_connect' AS on_ FROM evidence WHERE evidence_strength = 'strong'),
  islands AS (SELECT *, coalesce(sum(CAST(on_ AS INTEGER)) OVER (PARTITION BY device_id ORDER BY us, arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM marks),
  pairs AS (SELECT device_id, k, min(us) FILTER (NOT on_) AS outage_start, max(us) FILTER (on_) AS outage_end FROM islands GROUP BY ALL)
  SELECT device_id, outage_start, outage_end FROM pairs WHERE outage_start IS NOT NULL AND outage_end IS NOT NULL""")
def stm_outage_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = runs.read_table_stream(spark, sf_dir, "events").where("event_type IN ('error', 'signup')")
    marks = events.select(
        F.col("user_id").cast("string").alias("device_id"), F.expr(US).alias("us"), F.col("event_id").alias("arrival_seq"),
        (F.col("event_type") == "error").alias("offline"),
    )
    return runs.run_to_end(stateful.outage_pairs(marks))


_SNAPSHOTS = """snaps AS (SELECT device_id, us, evidence_type = 'lc_disconnect' AS is_offline, CASE WHEN arrival_seq % 4 > 0 THEN us - 60000000 END AS offline_since,
    CASE WHEN arrival_seq % 3 > 0 THEN us - 1000000 END AS connect_us, arrival_seq FROM evidence WHERE evidence_strength = 'strong')"""


_RECOVERIES = f"""WITH {_SNAPSHOTS}, islands AS (SELECT *, coalesce(sum(CAST(NOT is_offline AS INTEGER)) OVER (PARTITION BY device_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM snaps),
  s AS (SELECT device_id, k, coalesce(max_by(offline_since, us) FILTER (is_offline AND offline_since IS NOT NULL), min(us) FILTER (is_offline)) AS outage_start,
    max(us) FILTER (NOT is_offline) AS seen_us, max(connect_us) FILTER (NOT is_offline) AS connect_us FROM islands GROUP BY ALL)
  SELECT device_id, outage_start, CASE WHEN connect_us > outage_start THEN connect_us ELSE seen_us END AS outage_end, seen_us FROM s WHERE outage_start IS NOT NULL AND seen_us IS NOT NULL"""


@query(_RECOVERIES)
def win_recoveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.recoveries(_snapshots(spark, sf_dir).drop("arrival_seq"))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("arrival_seq")
    return shape(spark, sf_dir, "evidence").where("evidence_strength = 'strong'").select(
        "device_id", "us", (F.col("evidence_type") == "lc_disconnect").alias("is_offline"),
        F.when(seq % 4 > 0, F.col("us") - 60_000_000).alias("offline_since"), F.when(seq % 3 > 0, F.col("us") - 1_000_000).alias("connect_us"),
        "arrival_seq",
    )


HOUR_US = 3_600_000_000


@query(_RECOVERIES)
def stm_snapshot_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots come in three deliveries, each run by a new query from the last one's progress; some come a delivery late."""
    snaps = _snapshots(spark, sf_dir)
    ends = [NOW_US - 20 * 24 * HOUR_US, NOW_US - 10 * 24 * HOUR_US]
    # a snapshot of the last half hour before a delivery may come with the next one
    late = F.when(F.col("arrival_seq") % 3 == 0, F.lit(HOUR_US // 2)).otherwise(0)
    part = sum((F.when(F.col("us") + late > end, 1).otherwise(0) for end in ends), F.lit(0))
    staged, out, progress = (runs.scratch(spark, n) for n in ("snapshots", "recoveries", "progress"))
    feed = snaps.withColumn("part", part).drop("arrival_seq")
    tick = spark.range(1).select(
        F.lit(snapshots.TICK).alias("device_id"), F.lit(NOW_US + 100 * 24 * HOUR_US).alias("us"), F.lit(False).alias("is_offline"),
        F.lit(None).cast("long").alias("offline_since"), F.lit(None).cast("long").alias("connect_us"),
    )
    for k in range(len(ends) + 2):
        delivery = feed.where(F.col("part") == k).drop("part") if k <= len(ends) else tick
        delivery.write.mode("append").parquet(staged)
        stream = spark.readStream.schema(delivery.schema).parquet(staged)
        with runs.rocksdb(spark):
            runs.carry_on(snapshots.recoveries(stream), out, progress)
    found = spark.read.schema(snapshots.RECOVERY).parquet(out)
    return found.groupBy("device_id", "outage_start", "outage_end").agg(F.min("seen_us").alias("seen_us"))


@query(f"SELECT event_id, epoch_us(ts) AS us, epoch_us(ts) > {NOW_US - 86400000000 * 10} AS late FROM events")
def stm_late_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = runs.read_table_stream(spark, sf_dir, "events").select("event_id", F.expr(US).alias("us"))
    out = runs.scratch(spark, "late")

    def divert(batch: DataFrame, number: int) -> None:
        good, bad = stateful.split_late(batch, NOW_US - 86_400_000_000 * 10)
        both = good.withColumn("late", F.lit(False)).unionByName(bad.withColumn("late", F.lit(True)))
        both.write.mode("overwrite").parquet(f"{out}/batch={number}")  # a repeated batch replaces itself

    runs.run_batches(events, divert)
    return spark.read.parquet(out).select("event_id", "us", "late")


@query()
def stm_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = runs.read_table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return runs.run_to_end(stateful.freshness(events))


SCORED_FROM = NOW_US - 10 * 24 * HOUR_US
MODEL_KEYS = ["view", "click"]


def _risk_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Features of every anchor with y, whether the device disconnects in the next day; and the features' names."""
    wide = device_features(shape(spark, sf_dir, "telemetry"), MODEL_KEYS)
    columns = [c for c in wide.columns if "__" in c]
    off = shape(spark, sf_dir, "evidence").where("evidence_type = 'lc_disconnect'")
    starts = off.select("device_id", F.col("us").alias("outage_start"), F.lit(None).cast("long").alias("outage_end"))
    ahead = outages.sweep(wide.select("device_id", "anchor_us", *columns), starts, 24 * HOUR_US)
    return ahead.withColumn("y", (F.col("n_ahead") > 0).cast("int")).drop("inside", "n_ahead"), columns


def _stored_model(spark: SparkSession, rows: DataFrame, columns: list[str]) -> str:
    """Fitted on anchors whose next day is over before scoring begins."""
    path = runs.scratch(spark, "model")
    models.save(models.fit(rows.where(F.col("anchor_us") < SCORED_FROM - 24 * HOUR_US), columns, trees=5, depth=3), columns, path)
    return path


@query()
def ml_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the first two thirds of the month, store, load, and score the rest."""
    rows, columns = _risk_rows(spark, sf_dir)
    rows = runs.written(rows, "risk-rows")
    model, columns = models.load(spark, _stored_model(spark, rows, columns))
    return models.predict(model, rows.where(F.col("anchor_us") >= SCORED_FROM), columns).select("device_id", "anchor_us", "probability", "risk_score", "tier")


def nightly_steps(spark: SparkSession, sf_dir: str, model_path: str) -> list[chain.Step]:
    """Registry, readings, features, scores of each device's last anchor, and the report with devices without data."""
    def features(done: dict[str, DataFrame]) -> DataFrame:
        wide = device_features(done["readings"], MODEL_KEYS)
        return wide.join(wide.groupBy("device_id").agg(F.max("anchor_us").alias("anchor_us")), ["device_id", "anchor_us"])

    def score(done: dict[str, DataFrame]) -> DataFrame:
        model, columns = models.load(spark, model_path)
        return models.predict(model, done["features"], columns).select("device_id", "anchor_us", "probability", "risk_score", "tier")

    def report(done: dict[str, DataFrame]) -> DataFrame:
        both = done["registry"].where("keep").join(done["scores"], "device_id", "left")
        silent = F.col("probability").isNull()
        return both.select(
            "device_id", F.col("name").alias("device_name"), "anchor_us", "probability", "risk_score",
            F.when(silent, "NO_DATA").otherwise(F.col("tier")).alias("tier"), F.when(silent, "no telemetry in the window").alias("note"),
        )

    recent = lambda done: shape(spark, sf_dir, "telemetry").where(F.col("us") >= SCORED_FROM)
    return [
        chain.Step("registry", lambda done: quality.decide_devices(shape(spark, sf_dir, "devices"))),
        chain.Step("readings", recent), chain.Step("features", features, ("readings",), tolerated=False),
        chain.Step("scores", score, ("features",), tolerated=False), chain.Step("report", report, ("registry", "scores"), tolerated=False),
    ]


@query()
def nightly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The night's report: every device in service with its tier, those without data last in probability."""
    rows, columns = _risk_rows(spark, sf_dir)
    steps = nightly_steps(spark, sf_dir, _stored_model(spark, runs.written(rows, "risk-rows"), columns))
    outcome, done, _ = chain.run(spark, steps, runs.scratch(spark, "nightly"))
    if outcome is chain.Outcome.FAILED:
        raise RuntimeError("the nightly run ended early")
    return done["report"]
