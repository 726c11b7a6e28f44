"""Queries on quarantine, policy and point-in-time features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import vocabulary as V
from quarry.functions.scalars import DAY_US, HOUR_US
from quarry.operators import quality, trailing
from quarry.sources.tables import shape, sql

from .registry import query

#: The last record of the synthetic month is before 2024-02-01; nothing depends on the clock.
NOW_US = 1_706_745_600_000_000
START_US = 1_704_067_200_000_000
STEP_US = 6 * HOUR_US
KEYS = ["click", "error", "purchase", "signup", "view"]

_PARSED = """
  SELECT *, epoch_us(try_cast(time AS TIMESTAMP)) AS us FROM raw_telemetry"""
_JUDGED = f"""
  parsed AS ({_PARSED}),
  reasoned AS (SELECT *, CASE WHEN time IS NULL THEN 'null_ts' WHEN us IS NULL THEN 'unparseable_ts'
      WHEN us < 946684800000000 THEN 'epoch_like' WHEN us > {NOW_US} + 21600000000 THEN 'future_ts'
      WHEN value_num IS NULL AND value_text IS NULL THEN 'no_value' END AS first_reason FROM parsed),
  judged AS (SELECT *, CASE WHEN first_reason IS NOT NULL THEN first_reason
      WHEN row_number() OVER (PARTITION BY device_id, key, us, first_reason IS NULL ORDER BY arrival_seq DESC) > 1 THEN 'duplicate'
      END AS reason, CASE WHEN value_num IS NOT NULL THEN 'numeric' ELSE 'text' END AS value_kind FROM reasoned)"""
#: Anchors every six hours, per device and key, from the first reading (rounded up) to the global end.
_ANCHORS = f"""
  pairs AS (SELECT device_id, key, min(us) AS start_us FROM telemetry GROUP BY ALL),
  ends AS (SELECT max(us) AS end_us FROM telemetry),
  anchors AS (SELECT device_id, key, unnest(generate_series(
      CAST(ceil(start_us::DOUBLE / {STEP_US}) AS BIGINT) * {STEP_US}, end_us, {STEP_US})) AS anchor_us FROM pairs, ends)"""


def anchors_of(readings: DataFrame) -> DataFrame:
    end = readings.agg(F.max("us").alias("end_us"))
    pairs = readings.groupBy("device_id", "key").agg(F.min("us").alias("start_us"))
    return trailing.grid(pairs.crossJoin(F.broadcast(end)), STEP_US, by=("device_id", "key"))  # end: one row


@query(f"WITH {_JUDGED} SELECT device_id, key, arrival_seq, us, value_kind, reason FROM judged")
def flt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quarantine(shape(spark, sf_dir, "raw_telemetry"), NOW_US)
    return judged.select("device_id", "key", "arrival_seq", "us", "value_kind", "reason")


@query(f"""WITH {_JUDGED} SELECT count(*) AS n_rows, count_if(time IS NULL) AS null_ts,
  count_if(time IS NOT NULL AND us IS NULL) AS unparseable_ts, count_if(us < 946684800000000) AS epoch_like,
  count_if(us > {NOW_US} + 21600000000) AS future_ts, count_if(value_num IS NULL AND value_text IS NULL) AS no_value,
  count_if(reason = 'duplicate') AS duplicate, count_if(reason IS NULL) AS clean FROM judged""")
def flt_quarantine_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantine_stats(shape(spark, sf_dir, "raw_telemetry"), NOW_US)


@query("""SELECT device_id, key, arrival_seq, us, CASE WHEN regexp_matches(n, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
    THEN try_cast(n AS DOUBLE) END AS value_num
  FROM (SELECT *, CASE WHEN arrival_seq % 10 = 0 THEN 'NaN' WHEN arrival_seq % 10 = 1 THEN '1d' WHEN arrival_seq % 10 = 2 THEN NULL
    ELSE CAST(arrival_seq AS STRING) || '.5' END AS n FROM telemetry) WHERE us IS NOT NULL""")
def flt_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.functions.scalars import number

    text = sql(spark, sf_dir, """
      SELECT *, CASE WHEN arrival_seq % 10 = 0 THEN 'NaN' WHEN arrival_seq % 10 = 1 THEN '1d' WHEN arrival_seq % 10 = 2 THEN NULL
        ELSE CAST(arrival_seq AS STRING) || '.5' END AS n FROM {telemetry}""")  # fmt: skip
    return text.where("us IS NOT NULL").select("device_id", "key", "arrival_seq", "us", number(F.col("n")).alias("value_num"))


_LATEST = """latest AS (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY device_id, key, request ORDER BY seq DESC) = 1),
  usable AS (SELECT DISTINCT device_id, key FROM latest WHERE completeness = 'complete')"""


@query(f"WITH {_LATEST} SELECT t.device_id, t.key, arrival_seq, us FROM telemetry t JOIN usable u USING (device_id, key) WHERE t.key IN ('view', 'click')")
def flt_usable_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = quality.usable_pairs(shape(spark, sf_dir, "ledger"))
    wanted = shape(spark, sf_dir, "telemetry").where(F.col("key").isin("view", "click"))
    return wanted.join(usable, ["device_id", "key"], "left_semi").select("device_id", "key", "arrival_seq", "us")


@query(f"WITH {_LATEST} SELECT device_id, key FROM usable")
def src_telemetry_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.usable_pairs(shape(spark, sf_dir, "ledger"))


@query("SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY device_id, key, request ORDER BY seq DESC) = 1")
def win_ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_ledger(shape(spark, sf_dir, "ledger"), ["device_id", "key", "request"])


_SAMPLE_KEYS = [
    "device_id", "zone_name", "title_x", "imei", "mac_address", "api_key", "password", "latitude", "raw_frame", "fault_score", "health_score",
    "alarm_count", "active", "lastConnectTs", "heartbeat_BAS", "status", "usage_history", "temperature", "cpu", "battery_voltage",
    "humidity", "uptimeTotal", "ts_severity", "errorCount", "rock", "gps_fix", "geohash", "y_next", "NULL_LIKE",
]
_KEY_ROWS = "(SELECT unnest([" + ", ".join(f"'{k}'" for k in _SAMPLE_KEYS) + "]) AS key UNION ALL SELECT DISTINCT key FROM telemetry)"


def _case(rules: list[tuple[str, str]], prefix: str = "") -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(key, '(?i){p}') THEN '{prefix}{n}'" for p, n in rules) + " END"


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(k,) for k in _SAMPLE_KEYS], "key string")
    return listed.unionByName(shape(spark, sf_dir, "telemetry").select("key").distinct())


@query(f"SELECT key, {_case(V.EXCLUSIONS)} AS reason FROM {_KEY_ROWS}")
def prd_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir).select("key", quality.exclusion_reason(F.col("key")).alias("reason"))


@query(f"""SELECT key, coalesce({_case(V.EXCLUSIONS, 'denylist:')}, CASE WHEN key NOT IN ({', '.join(f"'{k}'" for k in V.ALLOWED_KEYS)})
  THEN 'unreviewed:not_in_allowlist' END) AS reason FROM {_KEY_ROWS}""")
def prd_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir).select("key", quality.policy_reason(F.col("key")).alias("reason"))


_NAME_HIT = "CASE " + " ".join(f"WHEN regexp_matches(name, '(?i){p}') THEN '{p}'" for p in V.TEST_NAMES) + " END"


@query(f"""WITH hits AS (SELECT *, lower(type) AS kind, {_NAME_HIT} AS hit FROM devices),
  decided AS (SELECT *, CASE WHEN device_id = '1' THEN 'explicit_allow' WHEN device_id = '2' THEN 'explicit_deny'
    WHEN kind IN ('test', 'demo', 'simulator', 'synthetic') THEN 'test_type:' || kind
    WHEN hit IS NOT NULL AND (contains(kind, 'test') OR contains(kind, 'demo') OR contains(kind, 'sim')) THEN 'name_pattern+type:' || hit || '+' || kind
    WHEN hit IS NOT NULL AND key_count = 0 THEN 'name_pattern+no_keys:' || hit
    WHEN hit IS NOT NULL THEN 'name_pattern_only:' || hit || '|kept_pending_review'
    WHEN coalesce(customer_id, '') = '' THEN 'no_customer' WHEN key_count < 2 THEN 'inactive:min_keys=2' ELSE 'real_device' END AS reason FROM hits)
  SELECT device_id, reason, reason IN ('explicit_allow', 'real_device') OR reason LIKE '%kept_pending_review' AS keep FROM decided""")
def prd_device_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = quality.decide_devices(shape(spark, sf_dir, "devices"), require_customer=True, min_keys=2, allow=["1"], deny=["2"])
    return decided.select("device_id", "reason", "keep")


_STATS = "stats AS (SELECT key, count(*) AS n_rows, count(value_num) AS n_num, count(value_text) AS n_text FROM telemetry GROUP BY key)"


@query(f"""WITH {_STATS}, kinds AS (SELECT *, CASE WHEN n_num >= n_text AND n_num > 0 THEN 'numeric' WHEN n_text > 0 THEN 'text' END AS kind
    FROM stats WHERE key <> 'purchase')
  SELECT key, kind, n_rows, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY kind ORDER BY (key = 'view') DESC, n_rows DESC, key) AS rank FROM kinds) WHERE rank <= 3""")
def prj_select_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = shape(spark, sf_dir, "telemetry").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value_num").alias("n_num"), F.count("value_text").alias("n_text")
    )
    chosen = quality.select_feature_keys(stats, watchlist=["view"], force_out=["purchase"], numeric_top=3)
    return chosen.select("key", "kind", "n_rows", "rank")


def _stats_sql(h: int) -> str:
    w = f"r.us > a.anchor_us - {h * HOUR_US} AND r.us <= a.anchor_us"
    v, x = f"CASE WHEN {w} THEN value_num END", f"CASE WHEN {w} AND value_num IS NOT NULL THEN r.us / {float(HOUR_US)} END"
    return f"""count({v}) AS n_{h}h, round(avg({v}), 6) AS mean_{h}h, min({v}) AS min_{h}h, max({v}) AS max_{h}h,
      CASE WHEN count({v}) >= 6 THEN round(stddev_samp({v}), 6) END AS std_{h}h,
      CASE WHEN count({v}) >= 6 AND var_pop({x}) > 0 THEN round(covar_pop({v}, {x} - {START_US / HOUR_US}) / var_pop({x} - {START_US / HOUR_US}), 6) END AS slope_{h}h,
      round(greatest(0.0, 1.0 - count({v}) / {float(max(1, h * 12))}), 6) AS missing_frac_{h}h"""


@query(f"""WITH {_ANCHORS} SELECT a.device_id, a.key, a.anchor_us, {_stats_sql(24)}, {_stats_sql(168)}
  FROM anchors a LEFT JOIN telemetry r ON a.device_id = r.device_id AND a.key = r.key AND r.us > a.anchor_us - {168 * HOUR_US} AND r.us <= a.anchor_us
  GROUP BY ALL""")
def agg_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    found = trailing.trailing_stats(anchors_of(readings), readings, [24, 168])
    rounded = [F.round(c, 6).alias(c) if c.split("_")[0] in ("mean", "std", "slope", "missing") else c for c in found.columns]
    return found.select(rounded)


@query(f"""WITH {_ANCHORS} SELECT a.device_id, a.key, a.anchor_us,
    count(CASE WHEN r.us >= a.anchor_us - {6 * HOUR_US} THEN value_num END) AS n_6h,
    count(value_num) AS n_24h, round(avg(value_num), 6) AS mean_24h, min(value_num) AS min_24h, max(value_num) AS max_24h,
    CASE WHEN count(value_num) = 1 THEN 0.0 ELSE round(stddev_samp(value_num), 6) END AS std_24h
  FROM anchors a LEFT JOIN telemetry r ON a.device_id = r.device_id AND a.key = r.key AND r.us BETWEEN a.anchor_us - {24 * HOUR_US} AND a.anchor_us
  GROUP BY ALL""")
def win_range_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    found = trailing.trailing_stats(anchors_of(readings), readings, [6, 24], closed=True)
    return found.select(
        "device_id", "key", "anchor_us", "n_6h", "n_24h", F.round("mean_24h", 6).alias("mean_24h"), "min_24h", "max_24h",
        F.round("std_24h", 6).alias("std_24h"),
    )


_ASOF = "SELECT a.*, r.us AS source_us, r.value_num, r.value_text FROM anchors a ASOF LEFT JOIN telemetry r ON a.device_id = r.device_id AND a.key = r.key AND a.anchor_us >= r.us"


@query(f"WITH {_ANCHORS} SELECT device_id, key, anchor_us, source_us, value_num FROM ({_ASOF})")
def join_asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    return trailing.asof_backward(anchors_of(readings), readings, ["value_num"])


@query(f"""WITH {_ANCHORS}, found AS (SELECT *, (anchor_us - source_us) / {float(HOUR_US)} AS age FROM ({_ASOF}))
  SELECT device_id, key, anchor_us, age AS last_age_h, CASE WHEN age <= 6 THEN value_num END AS last,
    CAST(CASE WHEN age <= 6 THEN 1 ELSE 0 END AS INTEGER) AS ffill_capped, CAST(CASE WHEN age IS NULL OR age > 24 THEN 1 ELSE 0 END AS INTEGER) AS stale FROM found""")
def win_last_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    found = trailing.capped_last(trailing.asof_backward(anchors_of(readings), readings, ["value_num"]))
    return found.select("device_id", "key", "anchor_us", "last_age_h", "last", "ffill_capped", "stale")


@query(f"""WITH {_ANCHORS}, moves AS (SELECT *, lag(us) OVER w AS before_us, lag(value_text) OVER w AS before
    FROM telemetry WHERE value_text IS NOT NULL WINDOW w AS (PARTITION BY device_id, key ORDER BY us, arrival_seq))
  SELECT a.device_id, a.key, a.anchor_us, count(value_text) AS text_n, count(DISTINCT value_text) AS text_distinct,
    count(CASE WHEN before_us > a.anchor_us - {24 * HOUR_US} AND value_text <> before THEN 1 END) AS text_changes
  FROM anchors a LEFT JOIN moves r ON a.device_id = r.device_id AND a.key = r.key AND r.us > a.anchor_us - {24 * HOUR_US} AND r.us <= a.anchor_us
  GROUP BY ALL""")
def win_text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    return trailing.text_stats(anchors_of(readings), readings)


_OBSERVED = f"""observed AS (SELECT device_id, key, us,
    avg(value_num) OVER (PARTITION BY device_id, key ORDER BY us RANGE BETWEEN {24 * HOUR_US - 1} PRECEDING AND CURRENT ROW) AS recent,
    avg(value_num) OVER w28 AS base_mean, stddev_samp(value_num) OVER w28 AS base_sd, count(value_num) OVER w28 AS base_n
  FROM telemetry WHERE value_num IS NOT NULL
  WINDOW w28 AS (PARTITION BY device_id, key ORDER BY us RANGE BETWEEN {28 * DAY_US - 1} PRECEDING AND CURRENT ROW))"""


@query(f"""WITH {_ANCHORS}, {_OBSERVED},
  r AS (SELECT a.*, o.us AS r_us, o.recent FROM anchors a ASOF LEFT JOIN observed o ON a.device_id = o.device_id AND a.key = o.key AND a.anchor_us >= o.us),
  shifted AS (SELECT *, anchor_us - {24 * HOUR_US} AS cut FROM r),
  j AS (SELECT s.*, o.us AS j_us, o.base_mean, o.base_sd, o.base_n FROM shifted s ASOF LEFT JOIN observed o ON s.device_id = o.device_id AND s.key = o.key AND s.cut >= o.us)
  SELECT device_id, key, anchor_us, CASE WHEN r_us >= cut AND r_us > j_us AND base_n >= 10 THEN round(greatest(-50.0, least(50.0,
    (recent - base_mean) / greatest(coalesce(base_sd, 0.0), greatest(abs(base_mean), 1.0) * 1e-3))), 6) END AS z FROM j""")
def win_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    found = trailing.baseline_z(anchors_of(readings), readings)
    return found.select("device_id", "key", "anchor_us", F.round("z", 6).alias("z"))


@query(f"WITH {_OBSERVED} SELECT device_id, key, us, round(recent, 6) AS recent, round(base_mean, 6) AS base_mean, round(base_sd, 6) AS base_sd, base_n FROM observed")
def win_rolling_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("device_id", "key").orderBy("us")
    recent, norm = order.rangeBetween(-24 * HOUR_US + 1, 0), order.rangeBetween(-28 * DAY_US + 1, 0)
    return shape(spark, sf_dir, "telemetry").where("value_num IS NOT NULL").select(
        "device_id", "key", "us", F.round(F.avg("value_num").over(recent), 6).alias("recent"),
        F.round(F.avg("value_num").over(norm), 6).alias("base_mean"), F.round(F.stddev_samp("value_num").over(norm), 6).alias("base_sd"),
        F.count("value_num").over(norm).alias("base_n"),
    )


@query(f"""WITH {_ANCHORS}, gaps AS (SELECT device_id, key, us, (us - lag(us) OVER (PARTITION BY device_id, key ORDER BY us)) / {float(HOUR_US)} AS gap_h FROM telemetry),
  worst AS (SELECT *, max(gap_h) OVER (PARTITION BY device_id, key ORDER BY us RANGE BETWEEN {7 * DAY_US - 1} PRECEDING AND CURRENT ROW) AS most FROM gaps WHERE gap_h IS NOT NULL)
  SELECT a.device_id, a.key, a.anchor_us, CASE WHEN r.us >= a.anchor_us - {7 * DAY_US} THEN round(most, 6) END AS gap_max_h FROM anchors a
  ASOF LEFT JOIN worst r ON a.device_id = r.device_id AND a.key = r.key AND a.anchor_us >= r.us""")
def win_gap_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shape(spark, sf_dir, "telemetry")
    found = trailing.longest_gap(anchors_of(readings), readings)
    return found.select("device_id", "key", "anchor_us", F.round("gap_max_h", 6).alias("gap_max_h"))


NUMERIC_KEYS, TEXT_KEYS, WINDOWS = ["click", "error", "purchase"], ["signup", "view"], [1, 6, 24, 168]
_STATS = ["n", "mean", "min", "max", "std", "slope", "missing_frac"]
_ROUNDED = ("mean", "std", "slope", "missing_frac", "z24h", "gap_max", "stale_key_frac")
#: Numbers of three keys and texts of all: some numeric keys say a text instead, text keys never give a number.
_MIXED = """SELECT device_id, key, us, arrival_seq,
  CASE WHEN key IN ('click', 'error', 'purchase') AND arrival_seq % 7 <> 3 THEN value_num END AS value_num,
  CASE WHEN arrival_seq % 11 = 0 THEN value_text ELSE CASE arrival_seq % 5 WHEN 0 THEN 'online' WHEN 1 THEN 'Disconnected' WHEN 2 THEN ' -12.5 ' WHEN 3 THEN 'No data' ELSE 'ok' END END AS value_text
  FROM {telemetry}"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 6).alias(c) if any(p in c for p in _ROUNDED) else F.col(c) for c in df.columns])


def _with_texts(
    anchors: DataFrame, known: DataFrame, panes: DataFrame, keys: list[str], texts: list[str], listed: list[str], first: list[str], of_windows: list[str], of_last: list[str]
) -> DataFrame:
    anchors = anchors.withColumn("key", F.explode(F.array(*map(F.lit, listed))))
    # each has a pivot of its own columns
    long = trailing.capped_last(trailing.key_features(anchors, known, ()))
    numeric, text = F.col("key").isin(keys), F.col("key").isin(texts)
    seen = numeric & F.col("source_us").isNotNull()
    extra = [
        F.max("row_us").alias("max_source_us"), F.sum("rows_total").alias("g__n_rows_total"), F.sum("rows_24h").alias("g__n_rows_24h"),
        F.count_if(F.col("rows_24h") > 0).alias("g__n_keys_24h"), F.count_if(seen).alias("g__n_numeric_keys"),
        F.count_if(text & F.col("text_last_len").isNotNull()).alias("g__n_text_keys"), F.min(F.when(numeric, F.col("last_age_h"))).alias("g__last_age_h"),
        (F.count_if(seen & (F.col("stale") == 1)) / F.greatest(F.lit(1), F.count_if(seen))).alias("g__stale_key_frac"),
    ]
    of_texts = ["text_n_24h", "text_distinct_24h", "text_changes_24h", "text_last_age_h", "text_last_len", "text_bad_flag", "text_last_numeric"]
    # a key's last values and texts are taken over together, as one row's
    rest = trailing.pivot_features(long, listed, [*of_last, *of_texts], extra=extra)
    rest = rest.drop(*(f"{k}__{v}" for k in listed for v in ([] if k in keys else of_last) + ([] if k in texts else of_texts)))
    wide = rest.join(trailing.pivot_features(panes, keys, of_windows), ["device_id", "anchor_us"], "left")
    said = [f"{k}__{v}" for k in texts for v in of_texts]
    return wide.select(*first, *said, *(c for c in rest.columns if c not in {*first, *said}))


def _without_texts(found: DataFrame, keys: list[str], first: list[str], beside: DataFrame | None) -> DataFrame:
    """The same columns from rows that have all keys already."""
    ages = [F.col(f"{k}__last_age_h") for k in keys]
    seen = sum((a.isNotNull().cast("long") for a in ages), F.lit(0))
    stale = sum((F.when(a.isNotNull() & (F.col(f"{k}__stale") == 1), 1).otherwise(0).cast("long") for k, a in zip(keys, ages)), F.lit(0))
    least = F.array_min(F.array(*ages))
    return found.select(
        *first, F.col("row_us").alias("max_source_us"), F.col("rows_total").alias("g__n_rows_total"), F.col("rows_24h").alias("g__n_rows_24h"),
        F.col("keys_24h").alias("g__n_keys_24h"), seen.alias("g__n_numeric_keys"), F.lit(0).cast("long").alias("g__n_text_keys"), least.alias("g__last_age_h"),
        (stale / F.greatest(F.lit(1), seen)).alias("g__stale_key_frac"), *([] if beside is None else [c for c in beside.columns if c not in ("device_id", "anchor_us")]),
    )


def device_features(
    readings: DataFrame, keys: list[str], text_keys: list[str] | None = None, hours: list[int] | None = None, beside: DataFrame | None = None
) -> DataFrame:
    """The wide training features per device and anchor: the flagship plan.

    Anchors begin with a device's first reading of a listed key; a key not yet seen has
    counts of 0, missing_frac 1 and stale 1. The g__ columns are over the listed keys.
    ``beside`` (device_id, anchor_us, others; a row per anchor at most) gives its other columns to the anchors it has.
    """
    texts = keys if text_keys is None else text_keys
    listed = sorted({*keys, *texts})
    known = readings.where(F.col("key").isin(listed))
    end = known.agg(F.max("us").alias("end_us"))
    starts = known.groupBy("device_id").agg(F.min("us").alias("start_us")).crossJoin(F.broadcast(end))  # end: one row
    windows = hours or WINDOWS
    # numbers' windows by panes, all else by one pass in order of time
    panes = trailing.pane_stats(known.where(F.col("key").isin(keys)), windows, STEP_US, end)
    anchors = trailing.grid(starts, STEP_US)
    of_windows, of_last = [f"{stat}_{h}h" for h in windows for stat in _STATS], ["last", "last_age_h", "stale", "ffill_capped"]
    first = ["device_id", "anchor_us", *(f"{k}__{v}" for k in keys for v in (*of_windows, *of_last))]
    if texts or not keys:
        wide = _with_texts(anchors, known, panes, keys, texts, listed, first, of_windows, of_last)
        wide = wide if beside is None else wide.join(beside, ["device_id", "anchor_us"], "left")
    else:
        wide = _without_texts(trailing.last_and_panes(anchors, known, panes, keys, beside=beside), keys, first, beside)
    # a window without a number has no row of panes
    bare = {f"{k}__n_{h}h": F.lit(0) for k in keys for h in windows} | {f"{k}__missing_frac_{h}h": F.lit(1.0) for k in keys for h in windows}
    wide = wide.withColumns({c: F.coalesce(c, nothing) for c, nothing in bare.items()})
    if 24 in windows:
        shares = sum((F.col(f"{k}__missing_frac_24h") for k in keys), F.lit(0.0)) / len(keys) if keys else F.lit(None).cast("double")
        wide = wide.withColumn("g__missing_frac_mean_24h", shares)
    return wide


def _wide_sql() -> str:
    num = ", ".join(f"max(CASE WHEN key = '{k}' THEN {s}_{h}h END) AS {k}__{s}_{h}h" for k in NUMERIC_KEYS for h in WINDOWS for s in _STATS)
    cap = ", ".join(
        f"""max(CASE WHEN key = '{k}' AND age <= 6 THEN last_num END) AS {k}__last, max(CASE WHEN key = '{k}' THEN age END) AS {k}__last_age_h,
        CAST(max(CASE WHEN key = '{k}' AND (age IS NULL OR age > 24) THEN 1 WHEN key = '{k}' THEN 0 END) AS INTEGER) AS {k}__stale,
        CAST(max(CASE WHEN key = '{k}' AND age <= 6 THEN 1 WHEN key = '{k}' THEN 0 END) AS INTEGER) AS {k}__ffill_capped""" for k in NUMERIC_KEYS
    )
    text = ", ".join(
        f"""max(CASE WHEN key = '{k}' THEN text_n END) AS {k}__text_n_24h, max(CASE WHEN key = '{k}' THEN text_distinct END) AS {k}__text_distinct_24h,
        max(CASE WHEN key = '{k}' THEN text_changes END) AS {k}__text_changes_24h, max(CASE WHEN key = '{k}' THEN text_age END) AS {k}__text_last_age_h,
        CAST(max(CASE WHEN key = '{k}' THEN length(last_text) END) AS INTEGER) AS {k}__text_last_len,
        CAST(max(CASE WHEN key = '{k}' THEN CAST(regexp_matches(last_text, '{V.BAD_TEXT}') AS INTEGER) END) AS INTEGER) AS {k}__text_bad_flag,
        CAST(max(CASE WHEN key = '{k}' THEN CAST(regexp_matches(last_text, '{V.NUMBER_TEXT}') AS INTEGER) END) AS INTEGER) AS {k}__text_last_numeric""" for k in TEXT_KEYS
    )
    listed = ", ".join(f"'{k}'" for k in NUMERIC_KEYS)
    day = f"r.us > a.anchor_us - {24 * HOUR_US}"
    return f"""WITH mixed AS ({_MIXED.replace("{telemetry}", "telemetry")}),
  kinds AS (SELECT *, CASE WHEN value_num IS NULL THEN value_text END AS said FROM mixed),
  moves AS (SELECT device_id, key, us, arrival_seq, lag(us) OVER w AS before_us, lag(said) OVER w AS before FROM kinds WHERE said IS NOT NULL WINDOW w AS (PARTITION BY device_id, key ORDER BY us, arrival_seq)),
  r AS (SELECT k.*, before_us, before FROM kinds k LEFT JOIN moves USING (device_id, key, us, arrival_seq)),
  ends AS (SELECT max(us) AS end_us FROM mixed), starts AS (SELECT device_id, min(us) AS start_us FROM mixed GROUP BY 1),
  da AS (SELECT device_id, unnest(generate_series(CAST(ceil(start_us::DOUBLE / {STEP_US}) AS BIGINT) * {STEP_US}, end_us, {STEP_US})) AS anchor_us FROM starts, ends),
  a AS (SELECT * FROM da CROSS JOIN (SELECT unnest({KEYS}) AS key)),
  long AS (SELECT a.device_id, a.key, a.anchor_us, {", ".join(_stats_sql(h) for h in WINDOWS)}, greatest(0.0, 1.0 - count(CASE WHEN {day} THEN value_num END) / 288.0) AS frac,
      count(r.us) AS rows_total, count(CASE WHEN {day} THEN r.us END) AS rows_24h, max(r.us) AS row_us,
      (a.anchor_us - max(r.us) FILTER (value_num IS NOT NULL)) / {float(HOUR_US)} AS age, arg_max(value_num, {{'a': r.us, 'b': arrival_seq}}) FILTER (value_num IS NOT NULL) AS last_num,
      (a.anchor_us - max(r.us) FILTER (said IS NOT NULL)) / {float(HOUR_US)} AS text_age, arg_max(said, {{'a': r.us, 'b': arrival_seq}}) FILTER (said IS NOT NULL) AS last_text,
      count(CASE WHEN {day} THEN said END) AS text_n, count(DISTINCT CASE WHEN {day} THEN said END) AS text_distinct,
      count(CASE WHEN {day} AND before_us > a.anchor_us - {24 * HOUR_US} AND said <> before THEN 1 END) AS text_changes
    FROM a LEFT JOIN r ON a.device_id = r.device_id AND a.key = r.key AND r.us <= a.anchor_us GROUP BY a.device_id, a.key, a.anchor_us)
  SELECT device_id, anchor_us, {num}, {cap}, {text}, max(row_us) AS max_source_us, CAST(sum(rows_total) AS BIGINT) AS g__n_rows_total, CAST(sum(rows_24h) AS BIGINT) AS g__n_rows_24h,
    count_if(rows_24h > 0)::BIGINT AS g__n_keys_24h, count_if(key IN ({listed}) AND age IS NOT NULL)::BIGINT AS g__n_numeric_keys, count_if(key NOT IN ({listed}) AND last_text IS NOT NULL)::BIGINT AS g__n_text_keys,
    min(CASE WHEN key IN ({listed}) THEN age END) AS g__last_age_h, round(count_if(key IN ({listed}) AND age > 24) / greatest(1, count_if(key IN ({listed}) AND age IS NOT NULL))::DOUBLE, 6) AS g__stale_key_frac,
    round(avg(CASE WHEN key IN ({listed}) THEN frac END), 6) AS g__missing_frac_mean_24h FROM long GROUP BY device_id, anchor_us"""


@query(_wide_sql())
def agg_device_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(device_features(sql(spark, sf_dir, _MIXED), NUMERIC_KEYS, TEXT_KEYS))


@query("SELECT device_id, max_by(value_num, us) FILTER (value_num IS NOT NULL AND arrival_seq % 3 = 0) AS value_num, max_by(value_text, us) FILTER (value_text IS NOT NULL) AS value_text, max(us) AS us FROM telemetry GROUP BY device_id")
def win_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "telemetry").withColumn("value_num", F.when(F.col("arrival_seq") % 3 == 0, F.col("value_num")))
    return trailing.latest_values(rows, "device_id", "us", ["value_num", "value_text"])


@query(f"WITH {_ANCHORS} SELECT device_id, key, anchor_us FROM anchors")
def win_hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors_of(shape(spark, sf_dir, "telemetry"))
