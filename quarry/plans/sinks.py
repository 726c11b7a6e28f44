"""Queries that write files and read them back, and checks on planted faults."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.functions.scalars import DAY_US
from quarry.operators import outputs, quality, trailing
from quarry.sources import by_device, extract, readers
from quarry.sources.tables import shape, sql
from quarry.streaming import runs, stateful

from .devices import _CARDS, _payload_sql, _texts
from .features import _ANCHORS, _JUDGED, KEYS, NOW_US, START_US, STEP_US, anchors_of
from .registry import query

ROW_CAP = 125


#: The day on which the source fails at the first run.
BAD_DAY = START_US // DAY_US + 2
FIRST_DAY, END_DAY = START_US // DAY_US, START_US // DAY_US + 31


def _failing(read: Callable[[extract.Batch], DataFrame]) -> Callable[[extract.Batch], DataFrame]:
    """The same source, broken off in the middle of one day."""

    def broken(batch: extract.Batch) -> DataFrame:
        rows = read(batch)
        if batch.day != BAD_DAY:
            return rows
        return rows.withColumn("reason", F.when(F.col("us").isNotNull(), F.raise_error(F.lit("connection lost"))).otherwise(F.col("reason")))

    return broken


def _laid_by_day(rows: DataFrame, day: Column) -> DataFrame:
    """The source: rows in a folder a day, so that a batch reads its own day."""
    path = runs.scratch(rows.sparkSession, "source")
    rows.withColumn("day", day).repartition("day").write.partitionBy("day").parquet(path)
    return rows.sparkSession.read.schema(StructType([*rows.schema, StructField("day", LongType())])).parquet(path)


@query(f"""WITH {_JUDGED}, batches AS (SELECT unnest(range({FIRST_DAY}, {END_DAY})) AS day, part FROM unnest([0, 1, 2]) AS t(part)),
  d AS (SELECT us // {DAY_US} AS day, CASE WHEN key IN ('click', 'error') THEN 0 WHEN key IN ('purchase', 'signup') THEN 1 ELSE 2 END AS part, reason, us FROM judged),
  c AS (SELECT b.day, b.part, count(us) AS n, count_if(us IS NOT NULL AND reason IS NULL) AS good, min(us) FILTER (reason IS NULL) AS oldest, max(us) FILTER (reason IS NULL) AS newest FROM batches b LEFT JOIN d ON (d.day, d.part) = (b.day, b.part) GROUP BY ALL),
  s AS (SELECT *, CASE WHEN n = 0 THEN 'empty' WHEN n >= {ROW_CAP} THEN 'over_cap' ELSE 'ok' END AS status FROM c)
  SELECT CAST(day AS BIGINT) AS day, CAST(part AS INTEGER) AS part, CASE WHEN day = {BAD_DAY} AND n > 0 THEN 'failed' ELSE status END AS first_status, status, n AS n_rows, CASE WHEN status = 'ok' THEN good ELSE 0 END AS n_written,
    CASE WHEN status = 'ok' THEN oldest END AS oldest_us, CASE WHEN status = 'ok' THEN newest END AS newest_us,
    CAST(CASE WHEN status = 'over_cap' OR day = {BAD_DAY} AND n > 0 THEN 2 ELSE 1 END AS INTEGER) AS attempt FROM s""")
def src_partitioned_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest after a run in which one day fails, and after the rerun that fills it in; rows written are those read back."""
    raw = shape(spark, sf_dir, "raw_telemetry")
    laid = _laid_by_day(raw, F.floor(quality.iso_micros(F.col("time")) / DAY_US).cast("long"))
    read, path = extract.telemetry_reader(laid, NOW_US), runs.scratch(spark, "extract")
    work = extract.batches(FIRST_DAY, END_DAY, KEYS, 2)
    first = runs.written(extract.run(spark, work, _failing(read), path, cap=ROW_CAP), "manifest").select("batch", F.col("status").alias("first_status"))
    second = extract.run(spark, work, read, path, cap=ROW_CAP)
    back = extract.Folder(spark, path).rows("device_id string, key string, us long")
    part = F.when(F.col("key").isin("click", "error"), 0).when(F.col("key").isin("purchase", "signup"), 1).otherwise(2)
    back = back.groupBy(F.floor(F.col("us") / DAY_US).alias("day"), part.alias("part")).agg(F.count(F.lit(1)).alias("_n"))
    found = second.drop("n_written").join(first, "batch").join(back, ["day", "part"], "left")
    return found.select("day", "part", "first_status", "status", "n_rows", F.coalesce("_n", F.lit(0)).alias("n_written"), "oldest_us", "newest_us", "attempt")


#: Kinds of events that are evidence of the devices' state.
STATE_EVENTS = ["lc_connect", "lc_disconnect", "current_attr_snapshot"]


@query("SELECT device_id, us, arrival_seq, evidence_type FROM evidence WHERE evidence_type IN ('lc_connect', 'lc_disconnect', 'current_attr_snapshot')")
def src_events_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the kinds of interest, day by day; the day that fails is filled in by the rerun."""
    events = shape(spark, sf_dir, "evidence").select("device_id", "us", "arrival_seq", "evidence_type")
    read, path = extract.events_reader(_laid_by_day(events, F.floor(F.col("us") / DAY_US).cast("long"))), runs.scratch(spark, "events")
    work = extract.batches(FIRST_DAY, END_DAY, STATE_EVENTS, len(STATE_EVENTS))
    extract.run(spark, work, _failing(read), path, cap=None)
    extract.run(spark, work, read, path, cap=None)
    return extract.Folder(spark, path).rows(events.schema)


def _by_device(spark: SparkSession, sf_dir: str) -> str:
    name = f"readings_{uuid.uuid4().hex}"
    by_device.save(shape(spark, sf_dir, "telemetry"), name, runs.scratch(spark, name), 16)
    return name


@query("""WITH s AS (SELECT *, us - lag(us) OVER (PARTITION BY device_id ORDER BY us) AS gap FROM telemetry)
  SELECT device_id, count(*) AS n_rows, count(DISTINCT key) AS n_keys, min(us) AS oldest_us, max(us) AS newest_us, max(gap) AS longest_gap_us FROM s GROUP BY 1""")
def src_device_parquet_iter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device after device from the layout by device: neither the window nor the grouping moves a row."""
    rows = by_device.load(spark, _by_device(spark, sf_dir))
    gaps = rows.withColumn("gap", F.col("us") - F.lag("us").over(Window.partitionBy("device_id").orderBy("us")))
    per_key = gaps.groupBy("device_id", "key").agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("a"), F.max("us").alias("b"), F.max("gap").alias("g"))
    return per_key.groupBy("device_id").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.min("a").alias("oldest_us"), F.max("b").alias("newest_us"), F.max("g").alias("longest_gap_us")
    )


@query("SELECT device_id, key, us, arrival_seq, value_num, value_text, device_id < '5' AS legacy FROM telemetry")
def src_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings at once from files of the old layout and of the new, a broken file among them."""
    path, rows = runs.scratch(spark, "bulk"), shape(spark, sf_dir, "telemetry")
    rows.where("device_id < '5'").write.parquet(f"{path}/legacy")
    rows.where("device_id >= '5'").withColumn("device", F.col("device_id")).repartition("device").write.partitionBy("device").parquet(f"{path}/devices")
    extract.Folder(spark, path).put("legacy/broken.parquet", b"not a parquet file")
    found = by_device.readable(spark, [f"{path}/legacy", f"{path}/devices"], rows.schema)
    return found.select(*rows.columns, F.contains("source_file", F.lit("/legacy/")).alias("legacy"))


@query("SELECT device_id, key, us, value_num FROM telemetry")
def src_ts_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache that one run began and the next completes."""
    path, rows = runs.scratch(spark, "cache"), shape(spark, sf_dir, "telemetry").select("device_id", "key", "us", "value_num")
    by_device.cached(rows.where("device_id < '5'"), path)
    return by_device.cached(rows, path)


@query("""SELECT device_id, us, 'event' AS origin, evidence_type FROM evidence UNION ALL
  SELECT device_id, start_us, 'alarm', 'alarm_offline' FROM alarms WHERE start_us IS NOT NULL AND alarm_type = 'DVR/NVR OFF'""")
def src_events_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = runs.scratch(spark, "events")
    events = shape(spark, sf_dir, "evidence").select("device_id", "us", "evidence_type", F.floor(F.col("us") / DAY_US).alias("day"))
    outputs.write_parquet(events.repartition("day"), f"{root}", by=["day"])
    off = shape(spark, sf_dir, "alarms").where("start_us IS NOT NULL AND alarm_type = 'DVR/NVR OFF'")
    outputs.write_parquet(off.select("device_id", F.col("start_us").alias("us"), F.lit("alarm_offline").alias("evidence_type")), f"{root}/bridged")
    return readers.staged_events(spark, root)


@query("SELECT device_id, key, us, value_num FROM telemetry")
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runs.scratch(spark, "readings")
    rows = shape(spark, sf_dir, "telemetry").withColumn("day", F.to_date(F.timestamp_micros("us")))
    outputs.write_parquet(rows.repartition("day"), path, by=["day"])
    return readers.staged(spark, path, 0, NOW_US).select("device_id", "key", "us", "value_num")


@query("SELECT device_id, name, branch, balance FROM devices")
def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = shape(spark, sf_dir, "devices").select("device_id", "name", "branch", "balance"), runs.scratch(spark, "devices")
    outputs.write_json_lines(rows, path)
    return readers.json_lines(spark, path, rows.schema).where("_corrupt_record IS NULL").drop("_corrupt_record")


_BANKS = "SELECT device_id, CASE WHEN key_count = 3 THEN '=' || name WHEN key_count = 4 THEN 'a \"b\", c' ELSE name END AS name, bank FROM {devices}"


@query("WITH b AS (" + _BANKS.replace("{devices}", "devices") + ") SELECT device_id, CASE WHEN name[1] = '=' THEN chr(39) || name ELSE name END AS name, bank FROM b")
def sink_csv_bom(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runs.scratch(spark, "sheet")
    outputs.write_csv_bom(sql(spark, sf_dir, _BANKS), path)
    return readers.csv(spark, path)


@query("SELECT device_id, us, evidence_type, 2 AS n_files FROM evidence WHERE evidence_strength = 'strong'")
def sink_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, path = shape(spark, sf_dir, "evidence").where("evidence_strength = 'strong'").select("device_id", "us", "arrival_seq", "evidence_type"), runs.scratch(spark, "labels")
    outputs.write_labels(labels, path)
    both = readers.csv(spark, f"{path}/csv", labels.schema).unionByName(spark.read.schema(labels.schema).json(f"{path}/jsonl"))
    return both.groupBy(*labels.columns).agg(F.count(F.lit(1)).cast("int").alias("n_files")).drop("arrival_seq")


def _alarm_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runs.scratch(spark, "alarms")
    outputs.write_csv_bom(shape(spark, sf_dir, "alarms").select("severity", "alarm_id"), path)
    return readers.csv(spark, path)


@query("SELECT severity, count(*) AS n, count_if(severity = '1-URGENT') AS n_kept, CAST(sum(alarm_id) AS BIGINT) AS ids FROM alarms GROUP BY 1")
def src_grid_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alarm_sheet(spark, sf_dir).groupBy("severity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == "1-URGENT").alias("n_kept"), F.sum(F.col("alarm_id").cast("long")).alias("ids")
    )


@query(f"WITH {_payload_sql(_CARDS)} SELECT count(*) AS n_lines, count_if(j IS NULL) AS n_errors FROM j")
def src_jsonl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runs.scratch(spark, "lines")
    _texts(spark, sf_dir, _CARDS).select("payload").write.text(path)
    return readers.json_errors(spark, path)


@query("""WITH b AS (SELECT severity, count(*) AS n_grid, count_if(NOT (severity = '3-MEDIUM' AND alarm_id % 5 = 0)) AS n_lines FROM alarms GROUP BY 1)
  SELECT severity, n_grid, n_lines, CASE WHEN n_grid = n_lines THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM b""")
def agg_grid_vs_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheet has all alarms; the lines, written apart, lack some of one severity, which must show."""
    path = runs.scratch(spark, "alarm-lines")
    outputs.write_json_lines(shape(spark, sf_dir, "alarms").where("NOT (severity = '3-MEDIUM' AND alarm_id % 5 = 0)").select("alarm_id", "severity"), path)
    count = lambda df, c: df.groupBy("severity").agg(F.count(F.lit(1)).alias(c))
    both = count(_alarm_sheet(spark, sf_dir), "n_grid").join(count(spark.read.schema("alarm_id long, severity string").json(path), "n_lines"), "severity", "full")
    return both.withColumn("verdict", F.when(F.col("n_grid").eqNullSafe(F.col("n_lines")), "MATCH").otherwise("MISMATCH"))


@query(f"""WITH {_ANCHORS}, f AS (SELECT a.device_id, a.key, a.anchor_us, CASE WHEN anchor_us % {7 * STEP_US} = 0 THEN anchor_us + 1 ELSE r.us END AS source_us
    FROM anchors a ASOF LEFT JOIN telemetry r ON a.device_id = r.device_id AND a.key = r.key AND a.anchor_us >= r.us)
  SELECT device_id, key, anchor_us, source_us FROM f WHERE source_us > anchor_us""")
def lbl_leak_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh anchor is given a source just after it, and these must be found."""
    readings = shape(spark, sf_dir, "telemetry")
    found = trailing.asof_backward(anchors_of(readings), readings, [])
    planted = F.when(F.col("anchor_us") % (7 * STEP_US) == 0, F.col("anchor_us") + 1).otherwise(F.col("source_us"))
    return trailing.late_sources(found.withColumn("source_us", planted))


@query("SELECT user_id, event_type, ts::DATE AS day, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def stm_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = runs.read_table_stream(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "value")
    return stateful.last_of_each(events, ["user_id", "event_type", "day"], "event_id", runs.scratch(spark, "last"))
