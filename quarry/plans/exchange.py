"""Queries on scans, ledgers, exports and key manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import DAY_US
from quarry.operators import outputs, quality
from quarry.sources import readers
from quarry.sources.tables import shape, sql, table
from quarry.streaming import runs

from .features import START_US
from .registry import query

WEEK = (START_US + 7 * DAY_US, START_US + 14 * DAY_US)


@query(f"SELECT device_id, key, us, value_num, value_text FROM telemetry WHERE us >= {WEEK[0]} AND us < {WEEK[1]} AND key IN ('view', 'error')")
def src_telemetry_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the range is stated on the column itself, so that it reaches the scan
    return sql(spark, sf_dir, """
      SELECT CAST(user_id AS STRING) AS device_id, event_type AS key, [us ts] AS us, value AS value_num, props AS value_text FROM {events}
      WHERE ts >= TIMESTAMP_NTZ'2024-01-08 00:00:00' AND ts < TIMESTAMP_NTZ'2024-01-15 00:00:00' AND event_type IN ('view', 'error')""")  # fmt: skip


@query("SELECT key, count(*) AS n_rows, count(value_num) AS n_num, count(value_text) AS n_text, count(DISTINCT device_id) AS n_devices FROM telemetry GROUP BY 1")
def src_key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "telemetry").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value_num").alias("n_num"), F.count("value_text").alias("n_text"), F.countDistinct("device_id").alias("n_devices")
    )


@query("SELECT event_id, CAST(user_id AS STRING) AS device_id, event_type FROM events WHERE event_type IN ('error', 'signup') AND ts < TIMESTAMP '2024-01-10 00:00:00'")
def src_events_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "events").where("event_type IN ('error', 'signup') AND ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'")
    return wanted.select("event_id", F.col("user_id").cast("string").alias("device_id"), "event_type")


@query(f"SELECT device_id, key, us FROM telemetry WHERE us >= {WEEK[0]} AND us < {WEEK[1]} AND device_id IN ('3', '5', '8')")
def src_staging_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week of three devices from staged day folders; time, devices and days reach the scan."""
    path = runs.scratch(spark, "staging")
    rows = shape(spark, sf_dir, "telemetry").withColumn("day", F.to_date(F.timestamp_micros("us")))
    outputs.write_parquet(rows.repartition("day"), path, by=["day"])
    return readers.staged(spark, path, *WEEK, devices=["3", "5", "8"]).select("device_id", "key", "us")


@query("SELECT DISTINCT device_id, key FROM telemetry")
def src_column_only_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "telemetry").select("device_id", "key").distinct()


_OUTPUTS = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Fault_Class: critical; fault_score: ' || CAST(event_id % 100 AS STRING) || '; Reasons: A | B'
  WHEN event_id % 4 = 1 THEN 'fault_score : ' || CAST(event_id % 100 AS STRING) || '.5' WHEN event_id % 4 = 2 THEN 'fault_class:LOW reasons: none' ELSE 'nothing here' END AS output FROM {events}"""


@query(f"""WITH o AS ({_OUTPUTS}), p AS (SELECT event_id, nullif(upper(regexp_extract(output, '(?i)fault_class\\s*:\\s*([A-Za-z]+)', 1)), '') AS fault_class,
    try_cast(nullif(regexp_extract(output, '(?i)fault_score\\s*:\\s*([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS fault_score, nullif(regexp_extract(output, '(?is)reasons\\s*:\\s*(.+)$', 1), '') AS reasons FROM o)
  SELECT *, coalesce(fault_class = 'CRITICAL' OR (fault_class IS NULL AND fault_score >= 70), false) AS critical FROM p""")
def src_jsonl_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sql(spark, sf_dir, _OUTPUTS).select("event_id", readers.fault_output(F.col("output")).alias("p"))
    return parsed.select("event_id", "p.*", readers.critical(F.col("p"), 70).alias("critical"))


@query("WITH spec AS (SELECT unnest(['view', 'click', 'humidity']) AS key), live AS (SELECT DISTINCT key FROM telemetry) SELECT coalesce(s.key, l.key) AS key, s.key IS NOT NULL AS in_spec, l.key IS NOT NULL AS discovered FROM spec s FULL JOIN live l ON s.key = l.key")
def src_key_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spark.createDataFrame([("view",), ("click",), ("humidity",)], "key string").withColumn("_s", F.lit(True))
    live = shape(spark, sf_dir, "telemetry").select("key").distinct().withColumn("_l", F.lit(True))
    return spec.join(live, "key", "full").select("key", F.col("_s").isNotNull().alias("in_spec"), F.col("_l").isNotNull().alias("discovered"))


@query("SELECT device_id, count(*) AS n_rows, min(us) AS oldest_us, max(us) AS newest_us FROM evidence GROUP BY 1")
def src_events_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "evidence").groupBy("device_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("us").alias("oldest_us"), F.max("us").alias("newest_us"))


@query("SELECT device_id, count(*) AS n_rows, min(start_us) AS oldest_us, max(start_us) AS newest_us FROM alarms GROUP BY 1")
def src_alarms_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "alarms").groupBy("device_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("start_us").alias("oldest_us"), F.max("start_us").alias("newest_us"))


@query("SELECT device_id, CASE WHEN bool_or(error IS NOT NULL) THEN 'failed' ELSE 'ok' END AS status, CAST(sum(n_rows) AS BIGINT) AS n_rows, max(newest_us) AS data_newest FROM ledger GROUP BY 1")
def src_cov_from_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.max(F.col("error").isNotNull())
    return shape(spark, sf_dir, "ledger").groupBy("device_id").agg(
        F.when(failed, "failed").otherwise("ok").alias("status"), F.sum("n_rows").alias("n_rows"), F.max("newest_us").alias("data_newest")
    )


@query("""WITH l AS (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY device_id, key, request ORDER BY seq DESC) = 1)
  SELECT completeness, count(*) AS n, count(DISTINCT device_id) AS n_devices, count(DISTINCT device_id || '|' || key) AS n_pairs, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM l GROUP BY 1""")
def fetch_ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = quality.latest_ledger(shape(spark, sf_dir, "ledger"), ["device_id", "key", "request"])
    return latest.groupBy("completeness").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("device_id").alias("n_devices"), F.countDistinct("device_id", "key").alias("n_pairs"), F.sum("n_rows").alias("n_rows")
    )


@query("SELECT DISTINCT device_id, key, request FROM ledger EXCEPT SELECT device_id, key, request FROM ledger WHERE completeness IN ('complete', 'empty_verified')")
def fetch_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger, same = shape(spark, sf_dir, "ledger"), ["device_id", "key", "request"]
    done = ledger.where(F.col("completeness").isin("complete", "empty_verified"))
    return ledger.select(same).distinct().join(done, same, "left_anti")


@query("SELECT split_part(error, ' ', 1) AS category, count(*) AS n FROM ledger WHERE error IS NOT NULL GROUP BY 1")
def agg_error_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = shape(spark, sf_dir, "ledger").where("error IS NOT NULL")
    return failed.groupBy(F.substring_index("error", " ", 1).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT device_id, completeness, count(*) AS n_rows, min(newest_us) AS oldest_us, max(newest_us) AS newest_us FROM ledger GROUP BY ALL")
def agg_source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "ledger").groupBy("device_id", "completeness").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("newest_us").alias("oldest_us"), F.max("newest_us").alias("newest_us")
    )


@query(f"""WITH d AS (SELECT key, us // {DAY_US} AS day, count(*) AS n_rows, count(DISTINCT device_id) AS n_devices FROM telemetry GROUP BY ALL)
  SELECT key, CAST(sum(n_rows) AS BIGINT) AS n_rows, max(n_devices) AS n_devices FROM d GROUP BY 1""")
def agg_key_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.floor(F.col("us") / DAY_US)
    per_day = shape(spark, sf_dir, "telemetry").groupBy("key", day.alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("device_id").alias("n_devices"))
    return per_day.groupBy("key").agg(F.sum("n_rows").alias("n_rows"), F.max("n_devices").alias("n_devices"))


@query("""WITH s AS (SELECT device_id, count(*) AS n FROM telemetry GROUP BY 1) SELECT count(*) AS n_devices, min(n) AS min_rows, max(n) AS max_rows, round(avg(n), 6) AS mean_rows,
  round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.99), 6) AS p99 FROM s""")
def agg_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = shape(spark, sf_dir, "telemetry").groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    at = lambda q, name: F.round(F.percentile("n", q), 6).alias(name)
    return sizes.agg(
        F.count(F.lit(1)).alias("n_devices"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"), F.round(F.avg("n"), 6).alias("mean_rows"),
        at(0.5, "p50"), at(0.9, "p90"), at(0.99, "p99"),
    )


@query("SELECT device_id, count(*) AS n_snapshots, count_if(evidence_type = 'lc_disconnect') AS n_offline, max(us) AS last_us FROM evidence GROUP BY 1")
def agg_snapshot_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "evidence").groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n_snapshots"), F.count_if(F.col("evidence_type") == "lc_disconnect").alias("n_offline"), F.max("us").alias("last_us")
    )


@query("SELECT key, n_rows, CAST(rank AS INTEGER) AS rank FROM (SELECT key, count(*) AS n_rows, row_number() OVER (ORDER BY count(*) DESC, key) AS rank FROM telemetry GROUP BY 1) WHERE rank <= 3")
def top_k_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = shape(spark, sf_dir, "telemetry").groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n_rows").desc(), "key"))).where("rank <= 3")  # one row per key


@query("SELECT alarm_id, CASE WHEN c IN ('=', '+', '-', '@') THEN '''' || cell ELSE cell END AS cell FROM (SELECT alarm_id, cell, left(cell, 1) AS c FROM (SELECT alarm_id, CASE alarm_id % 5 WHEN 0 THEN '=1+1' WHEN 1 THEN '@x' WHEN 2 THEN '-3' WHEN 3 THEN alarm_type END AS cell FROM alarms))")
def sink_csv_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = sql(spark, sf_dir, "SELECT alarm_id, CASE alarm_id % 5 WHEN 0 THEN '=1+1' WHEN 1 THEN '@x' WHEN 2 THEN '-3' WHEN 3 THEN alarm_type END AS cell FROM {alarms}")
    return outputs.safe_rows(cells).withColumn("alarm_id", F.col("alarm_id").cast("long"))


@query("SELECT arrival_seq, concat_ws(' ', 'key: ' || key, CASE WHEN arrival_seq % 3 > 0 THEN 'device_id: ' || device_id END) AS input FROM telemetry")
def sink_jsonl_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "telemetry").withColumn("device_id", F.when(F.col("arrival_seq") % 3 > 0, F.col("device_id")))
    line = outputs.training_line(["key", "device_id"], F.lit("OK"))
    return rows.select("arrival_seq", F.get_json_object(line, "$.input").alias("input"))


@query("SELECT device_id, concat_ws('; ', 'balance ' || printf('%.3f', balance), CASE WHEN key_count > 5 THEN 'keys ' || printf('%.3f', key_count::DOUBLE) END) AS line FROM devices")
def prj_serialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "devices").withColumn("keys", F.when(F.col("key_count") > 5, F.col("key_count")))
    return rows.select("device_id", outputs.feature_line(["balance", "keys"]).alias("line"))


@query("""WITH d AS (SELECT page_id, url, length(html) AS n FROM pages) SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, n FROM d WHERE n > 0""")
def prj_page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    n = F.length("html").cast("long")
    return pages.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"), n.alias("n")).where("n > 0")


@query("SELECT device_id, arrival_seq, us, probability >= 0.5 OR arrival_seq % 4 = 0 AS is_offline, CASE WHEN arrival_seq % 4 = 0 THEN us END AS offline_since FROM (SELECT *, anchor_us AS us FROM scored)")
def prj_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "scored").withColumnRenamed("anchor_us", "us")
    down = F.col("arrival_seq") % 4 == 0
    return rows.select("device_id", "arrival_seq", "us", ((F.col("probability") >= 0.5) | down).alias("is_offline"), F.when(down, F.col("us")).alias("offline_since"))


_RAW_KEYS = ["disk / cpu", "Disk", "heartbeat_BAS\\nCPU", "memory", " MEMORY ", "x/y/z", "", "temp"]


@query("WITH m AS (SELECT unnest([" + ", ".join(f"'{k}'" for k in [k.replace("\\n", "' || chr(10) || '") for k in _RAW_KEYS]) + """]) AS raw, generate_subscripts([""" + ", ".join("0" for _ in _RAW_KEYS) + """], 1) AS place),
  p AS (SELECT place, trim(unnest(string_split_regex(raw, '[/\\n]'))) AS key, generate_subscripts(string_split_regex(raw, '[/\\n]'), 1) AS part FROM m)
  SELECT key, CAST(place AS INTEGER) AS place FROM p WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY lower(key) ORDER BY place, part) = 1""")
def prj_key_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = [(k.replace("\\n", "\n"), i + 1) for i, k in enumerate(_RAW_KEYS)]
    raw = spark.createDataFrame(listed, "raw string, place int")
    parts = raw.select("place", F.posexplode(F.split("raw", "[/\n]")).alias("part", "key")).withColumn("key", F.trim("key")).where("key <> ''")
    first = Window.partitionBy(F.lower("key")).orderBy("place", "part")
    return parts.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select("key", "place")
