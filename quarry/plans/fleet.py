"""Queries on scores, the daily grid, hierarchies, metrics, joins and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.functions import vocabulary as V
from quarry.functions.scalars import DAY_US, HOUR_US
from quarry.operators import grid, hierarchy, metrics, scoring
from quarry.sources.tables import shape, sql, table

from .features import START_US
from .registry import query

START_DAY = START_US // DAY_US
END_DAY = START_DAY + 30

# ---- rule scores --------------------------------------------------------------------------------------------------

#: Device-days with every kind of value: words, missing words, numbers and counts.
_DAYS = """SELECT o_orderkey AS row_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'false' WHEN 1 THEN 'True' WHEN 2 THEN 'N/A' WHEN 3 THEN NULL ELSE '0' END AS statusbox_system_on,
  CASE o_orderkey % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN '' END AS statusbox_battery_low,
  CASE o_orderkey % 4 WHEN 0 THEN 'Offline' WHEN 1 THEN 'online' WHEN 2 THEN 'unknown' END AS "heartbeat_BAS",
  CASE o_orderkey % 6 WHEN 0 THEN 'DOWN' WHEN 1 THEN 'up' END AS "heartBeatTL",
  CAST(o_custkey % 3 AS STRING) AS rock_sd_na_count, CAST(o_custkey % 4 AS STRING) AS rock_cam_count,
  CASE o_custkey % 5 WHEN 0 THEN 'off' WHEN 1 THEN 'ok' END AS bas_hb, CASE o_custkey % 6 WHEN 0 THEN 'Armed' WHEN 1 THEN 'alarmed' WHEN 2 THEN '-' END AS bas_panel_state,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(CAST(100 + o_orderkey % 30 AS BIGINT) / 10 AS STRING) END AS ac_voltage,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 25 AS STRING) END AS log_fault_count,
  CAST(o_custkey % 5 AS STRING) AS hik_sd_bad_count, CASE o_orderkey % 8 WHEN 0 THEN 'FAULT' WHEN 1 THEN 'N/A' WHEN 2 THEN 'ok' WHEN 3 THEN 'bad' END AS nvr_status_snapshot,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 2000 AS STRING) END AS "BAS_Downtime_Minutes",
  CASE WHEN o_orderkey % 10 = 0 THEN '0' WHEN o_orderkey % 10 = 1 THEN NULL ELSE '5' END AS "Total_Data_Usage_num",
  CAST(o_orderkey % 101 AS STRING) AS disk, CAST(o_custkey % 101 AS STRING) AS cpu, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 90 AS STRING) END AS temperature,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey % 6 AS STRING) END AS hdd_error_count, CASE WHEN o_orderkey % 50 = 0 THEN 'failed' END AS sw_state,
  o_custkey AS device, CAST(o_orderkey % 30 AS BIGINT) AS day FROM {orders}"""


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, _DAYS.replace('"', "`"))


_MISS = "('', 'none', 'null', 'nan', 'n/a', 'na', 'unknown', 'undefined', '-')"


def _scored_sql() -> str:
    """The same rules, written as one list of (points, reason) per row."""
    w = lambda c: f'lower(trim("{c}"))'
    known = lambda c: f"coalesce({w(c)} NOT IN {_MISS}, false)"
    off = lambda c: f"{w(c)} IN ('offline', 'off', 'down', 'disconnected', '0', 'false')"
    n = lambda c: f'coalesce(try_cast("{c}" AS BIGINT), 0)'
    d = lambda c: f'try_cast("{c}" AS DOUBLE)'
    hit = lambda when, pts, why: f"CASE WHEN {when} THEN {{'p': CAST({pts} AS DOUBLE), 'r': {why}}} END"
    two = lambda *steps: "CASE " + " ".join(f"WHEN {a} THEN {{'p': CAST({p} AS DOUBLE), 'r': {r}}}" for a, p, r in steps) + " END"
    i = lambda c: f"CAST(CAST({d(c)} AS BIGINT) AS VARCHAR)"
    parts = [
        hit(f"{w('statusbox_system_on')} IN ('false', '0', 'no', 'off')", 35, "'SYS_OFF(+35)'"),
        hit(f"{w('statusbox_battery_low')} IN ('true', '1', 'yes', 'on', 'active')", 15, "'BATT_LOW(+15)'"),
        hit(off("heartbeat_BAS"), 15, "'heartbeat_BAS_OFFLINE(+15)'"),
        hit(off("heartBeatTL"), 6, "'heartBeatTL_OFFLINE(+6)'"),
        two(
            (f"{n('rock_cam_count')} > 0 AND {n('rock_sd_na_count')} = {n('rock_cam_count')}", 10, f"'ROCK_SD_ALL_NA(' || {n('rock_sd_na_count')} || '/' || {n('rock_cam_count')} || ')(+10)'"),
            (f"{n('rock_sd_na_count')} > 0", f"least(3 * {n('rock_sd_na_count')}, 9)", f"'ROCK_SD_NA=' || {n('rock_sd_na_count')} || '(+' || least(3 * {n('rock_sd_na_count')}, 9) || ')'"),
        ),
        hit(off("bas_hb"), 12, f"'BAS_HB_' || upper({w('bas_hb')}) || '(+12)'"),
        hit(f"{known('bas_panel_state')} AND {w('bas_panel_state')} NOT IN ('armed', 'disarmed', 'normal', 'stay', 'ok')", 8, f"'BAS_PANEL_' || upper({w('bas_panel_state')}) || '(+8)'"),
        hit(f"{d('ac_voltage')} > 0 AND {d('ac_voltage')} < 180", 10, f"'AC_V_LOW(' || CAST(CAST(round_even({d('ac_voltage')}, 0) AS BIGINT) AS VARCHAR) || 'V)(+10)'"),
        two(*((f"{n('log_fault_count')} >= {a}", p, f"'FAULT_EVT=' || {n('log_fault_count')} || '(+{p})'") for a, p in ((20, 20), (10, 12), (3, 6)))),
        hit(f"{n('hik_sd_bad_count')} > 0", f"least(5 * {n('hik_sd_bad_count')}, 15)", f"'SD_BAD=' || {n('hik_sd_bad_count')} || '(+' || least(5 * {n('hik_sd_bad_count')}, 15) || ')'"),
        hit("upper(trim(nvr_status_snapshot)) IN ('FAULT', 'BAD')", 30, "'NVR_FAULT(+30)'"),
        two(*((f"{d('BAS_Downtime_Minutes')} >= {a}", p, f"'BAS_DT_' || {i('BAS_Downtime_Minutes')} || 'm(+{p})'") for a, p in ((1440, 30), (480, 20), (60, 10)))),
        hit(f"{d('Total_Data_Usage_num')} = 0", 20, "'ZERO_DATA(+20)'"),
        hit(f"{d('cpu')} >= 90", 10, f"'CPU_HIGH(' || {i('cpu')} || '%)'"),
        two(*((f"{d('disk')} >= {a}", p, f"'DISK_{x}(' || {i('disk')} || '%)'") for a, p, x in ((90, 20, "CRIT"), (80, 12, "HIGH"), (75, 6, "WARN")))),
        two(*((f"{d('temperature')} >= {a}", p, f"'TEMP_{x}(' || {i('temperature')} || '°)'") for a, p, x in ((70, 12, "CRIT"), (60, 6, "WARN")))),
        hit(f"{n('hdd_error_count')} > 0", f"least(5 * {n('hdd_error_count')}, 20)", f"'HDD_ERR=' || {n('hdd_error_count')} || '(+' || least(5 * {n('hdd_error_count')}, 20) || ')'"),
        hit("upper(sw_state) IN ('FAILED', 'FAILED_UPDATE', 'ERROR')", 10, "'FW_FAIL(+10)'"),
    ]
    hits = "list_filter([" + ", ".join(parts) + "], lambda h: h IS NOT NULL)"
    return f"""days AS ({_DAYS.replace('{orders}', 'orders')}), hit AS (SELECT row_id, device, day, {hits} AS h FROM days),
      totals AS (SELECT row_id, device, day, h, round(least(100.0, coalesce(list_sum(list_transform(h, lambda x: x.p)), 0)), 2) AS score FROM hit),
      scored_days AS (SELECT row_id, device, day, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 70 THEN 'CRITICAL' WHEN score >= 45 THEN 'HIGH' WHEN score >= 20 THEN 'MEDIUM' ELSE 'HEALTHY' END AS severity,
        CASE WHEN len(h) = 0 THEN 'OK' ELSE array_to_string(list_transform(h[1:5], lambda x: x.r), ' | ') END AS reasons FROM totals)"""


def _scored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_daily(_days(spark, sf_dir)).select("row_id", "device", "day", "score", "severity", "reasons")


@query(f"WITH {_scored_sql()} SELECT row_id, score, severity, reasons FROM scored_days")
def score_ts_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_days(spark, sf_dir).select("row_id", "score", "severity", "reasons")


@query(f"WITH {_scored_sql()} SELECT row_id, device, day, score, severity, reasons FROM scored_days WHERE severity IN ('CRITICAL', 'HIGH') ORDER BY score DESC, row_id LIMIT 500")
def top_risk_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    risky = _scored_days(spark, sf_dir).where(F.col("severity").isin("CRITICAL", "HIGH"))
    return risky.orderBy(F.col("score").desc(), "row_id").limit(500)


@query(f"WITH {_scored_sql()} SELECT severity, CAST(least(floor(score / 20), 4) AS BIGINT) AS bucket, count(*) AS n FROM scored_days GROUP BY ALL")
def agg_severity_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = F.least(F.floor(F.col("score") / 20), F.lit(4)).cast("long")
    return _scored_days(spark, sf_dir).groupBy("severity", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_scored_sql()}, d AS (SELECT device, day, max(score) AS score FROM scored_days GROUP BY ALL),
  x AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY day) - 1 AS x FROM d),
  t AS (SELECT device, count(*) AS n_days, regr_slope(score, x) AS slope, min_by(score, day) AS first_score, max_by(score, day) AS last_score, round(avg(score), 6) AS mean_score, max(score) AS max_score FROM x GROUP BY 1)
  SELECT device, n_days, round(slope, 6) AS slope, first_score, last_score, mean_score, max_score, CASE WHEN slope > 0.1 THEN 'worsening' WHEN slope < -0.1 THEN 'improving' ELSE 'stable' END AS direction FROM t WHERE n_days >= 7""")
def agg_trend_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _scored_days(spark, sf_dir).groupBy("device", "day").agg(F.max("score").alias("score"))
    found = grid.score_trend(daily, by="device")
    # a slope that rounds to nothing keeps its sign
    slope = F.when((F.col("slope") < 0) & (F.round("slope", 6) == 0), F.lit(-0.0)).otherwise(F.round("slope", 6))
    return found.withColumns({"slope": slope, "mean_score": F.round("mean_score", 6)})


@query(f"""WITH {_scored_sql()} SELECT device, count(*) AS n_rows, round(avg(score), 6) AS mean_score, max(score) AS max_score, count_if(severity = 'CRITICAL') AS n_critical,
  count(DISTINCT day) FILTER (severity = 'CRITICAL') AS critical_days FROM scored_days GROUP BY 1""")
def agg_device_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    critical = F.col("severity") == "CRITICAL"
    return _scored_days(spark, sf_dir).groupBy("device").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("score"), 6).alias("mean_score"), F.max("score").alias("max_score"),
        F.count_if(critical).alias("n_critical"), F.countDistinct(F.when(critical, F.col("day"))).alias("critical_days"),
    )


def _scored_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shape(spark, sf_dir, "devices")
    score = F.pmod(F.round("balance").cast("long"), F.lit(101)).cast("double")
    return d.withColumn("score", score).withColumn("severity", S.severity(score))


_DEVICES = """d AS (SELECT *, CAST(((CAST(round(balance) AS BIGINT) % 101) + 101) % 101 AS DOUBLE) AS score FROM devices),
  s AS (SELECT *, CASE WHEN score >= 70 THEN 'CRITICAL' WHEN score >= 45 THEN 'HIGH' WHEN score >= 20 THEN 'MEDIUM' ELSE 'HEALTHY' END AS severity FROM d)"""
_SUMMARY = """count(*) AS n_devices, round(avg(score), 1) AS avg_score, max(score) AS max_score, count_if(severity = 'CRITICAL') AS n_critical,
  count_if(severity = 'HIGH') AS n_high, count_if(severity = 'MEDIUM') AS n_medium, count_if(severity = 'HEALTHY') AS n_healthy"""


@query(f"""WITH {_DEVICES} SELECT bank, zone, branch, {_SUMMARY}, 3 AS level FROM s GROUP BY bank, zone, branch
  UNION ALL SELECT bank, zone, NULL, {_SUMMARY}, 2 FROM s GROUP BY bank, zone UNION ALL SELECT bank, NULL, NULL, {_SUMMARY}, 1 FROM s GROUP BY bank""")
def agg_tree_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.rollup_summary(_scored_devices(spark, sf_dir), ["bank", "zone", "branch"])


@query(f"WITH {_DEVICES} SELECT bank, zone, {_SUMMARY}, count(DISTINCT branch) AS n_branches FROM s GROUP BY ALL")
def agg_hier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda x: F.count_if(F.col("severity") == x).alias(f"n_{x.lower()}")
    return _scored_devices(spark, sf_dir).groupBy("bank", "zone").agg(
        F.count(F.lit(1)).alias("n_devices"), F.round(F.avg("score"), 1).alias("avg_score"), F.max("score").alias("max_score"),
        *map(named, ("CRITICAL", "HIGH", "MEDIUM", "HEALTHY")), F.countDistinct("branch").alias("n_branches"),
    )


@query("SELECT bank, count(DISTINCT zone) AS n_zones, count(DISTINCT branch) AS n_branches FROM devices GROUP BY 1")
def agg_unique_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "devices").groupBy("bank").agg(F.countDistinct("zone").alias("n_zones"), F.countDistinct("branch").alias("n_branches"))


@query(f"""WITH {_DEVICES}, r AS (SELECT device_id, bank, zone, score, row_number() OVER (PARTITION BY bank, zone ORDER BY score DESC, device_id) AS turn, count(*) OVER (PARTITION BY bank, zone) AS n FROM s)
  SELECT device_id, bank, zone, score, CAST(turn AS INTEGER) AS turn FROM r ORDER BY turn, n DESC, bank, zone LIMIT 100""")
def top_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_devices(spark, sf_dir).select("device_id", "bank", "zone", "score")
    return grid.stratified(rows, ["bank", "zone"], [F.col("score").desc(), F.col("device_id")], 100)


@query("""SELECT bank, CAST(alarm_id % 30 AS BIGINT) AS day, count(DISTINCT a.device_id) AS n_devices, CAST(sum(CAST(round(weight * 100) AS BIGINT)) AS BIGINT) AS weight_cents, count_if(severity = '1-URGENT') AS n_urgent
  FROM alarms a JOIN devices d USING (device_id) GROUP BY ALL""")
def agg_bank_date_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = shape(spark, sf_dir, "alarms").join(shape(spark, sf_dir, "devices").select("device_id", "bank"), "device_id")
    return joined.groupBy("bank", (F.col("alarm_id") % 30).cast("long").alias("day")).agg(
        F.countDistinct("device_id").alias("n_devices"), F.sum(F.round(F.col("weight") * 100).cast("long")).alias("weight_cents"),
        F.count_if(F.col("severity") == "1-URGENT").alias("n_urgent"),
    )


# ---- daily grid ---------------------------------------------------------------------------------------------------

_NULLED = "SELECT device_id, key, us, arrival_seq, CASE WHEN arrival_seq % 9 = 0 THEN NULL ELSE value_num END AS value_num FROM {telemetry}"
_GRID = f"""n AS ({_NULLED.replace('{telemetry}', 'telemetry')}), l AS (SELECT device_id, key, us // {DAY_US} AS day, arg_max({{'v': value_num}}, {{'a': us, 'b': arrival_seq}}) AS v FROM n GROUP BY ALL),
  g AS (SELECT device_id, key, unnest(range({START_DAY}, {END_DAY + 1})) AS day FROM (SELECT DISTINCT device_id, key FROM n))"""


@query(f"""WITH {_GRID}, f AS (SELECT g.*, last_value(v IGNORE NULLS) OVER (PARTITION BY device_id, key ORDER BY day) AS v FROM g LEFT JOIN l USING (device_id, key, day))
  SELECT device_id, key, day, v.v AS value_num FROM f""")
def win_ffill_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.daily_last(sql(spark, sf_dir, _NULLED), START_DAY, END_DAY)


_COUNTS = f"""g AS (SELECT device_id, unnest(range({START_DAY}, {END_DAY + 1})) AS day FROM (SELECT DISTINCT device_id FROM telemetry)),
  c AS (SELECT device_id, us // {DAY_US} AS day, count_if(key = 'error') AS n FROM telemetry GROUP BY ALL),
  daily AS (SELECT device_id, day, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (device_id, day))"""


def _error_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.daily_counts(shape(spark, sf_dir, "telemetry"), F.col("key") == "error", START_DAY, END_DAY)


@query(f"WITH {_COUNTS} SELECT * FROM daily")
def win_daily_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _error_days(spark, sf_dir)


@query(f"""WITH {_COUNTS}, i AS (SELECT *, sum(CAST(n > 0 AS INTEGER)) OVER (PARTITION BY device_id ORDER BY day) AS k FROM daily),
  r AS (SELECT device_id, k, count(*) AS length, min(day) AS start FROM i WHERE n = 0 GROUP BY ALL),
  b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY length DESC, start) = 1)
  SELECT d.device_id, coalesce(length, 0) AS gap_days, start AS gap_start FROM (SELECT DISTINCT device_id FROM daily) d LEFT JOIN b USING (device_id)""")
def win_gap_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.longest_zero_run(_error_days(spark, sf_dir))


@query(f"""WITH m AS (SELECT *, coalesce(value_num <> lag(value_num) OVER (PARTITION BY device_id, key ORDER BY us, arrival_seq), false) AS c FROM ({_NULLED.replace('{telemetry}', 'telemetry')}))
  SELECT device_id, key, us // {DAY_US} AS day, count_if(c) AS n_changes FROM m GROUP BY ALL""")
def win_daily_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.daily_changes(sql(spark, sf_dir, _NULLED))


@query("SELECT key, count(DISTINCT device_id) AS n_devices, round(count(DISTINCT device_id) * 100.0 / (SELECT count(DISTINCT device_id) FROM telemetry), 2) AS pct FROM telemetry WHERE value_num IS NOT NULL OR value_text IS NOT NULL GROUP BY 1")
def agg_key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.key_coverage(shape(spark, sf_dir, "telemetry"))


@query("""WITH RECURSIVE e AS (SELECT 'b' || c_custkey AS child, 'z' || c_nationkey AS parent FROM customer UNION SELECT 'z' || n_nationkey, 'r' || n_regionkey FROM nation UNION SELECT 'r' || r_regionkey, 'top' FROM region UNION ALL SELECT 'top', 'r0'),
  w AS (SELECT child AS node, parent AS ancestor, 1 AS distance FROM e UNION ALL SELECT node, parent, distance + 1 FROM w JOIN e ON ancestor = child WHERE distance < 8)
  SELECT node, ancestor, CAST(min(distance) AS INTEGER) AS distance FROM w GROUP BY ALL""")
def join_ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = sql(spark, sf_dir, """
      SELECT 'b' || c_custkey AS child, 'z' || c_nationkey AS parent FROM {customer} UNION SELECT 'z' || n_nationkey, 'r' || n_regionkey FROM {nation}
      UNION SELECT 'r' || r_regionkey, 'top' FROM {region} UNION ALL SELECT 'top', 'r0'""")  # fmt: skip
    return grid.ancestors(edges)


#: Devices under branches, zones and regions, with two parents, parents that are not known or not walked through, a cycle, and a chain too deep.
_RELATIONS = """
  SELECT 'd' || c_custkey AS child, 'b' || c_custkey % 40 AS parent, 1 AS ord FROM {customer}
  UNION ALL SELECT 'd' || c_custkey, 'k' || c_nationkey % 5, 0 FROM {customer} WHERE c_custkey % 5 = 0
  UNION ALL SELECT 'd' || c_custkey, 'b' || c_custkey % 7, 2 FROM {customer} WHERE c_custkey % 7 = 0
  UNION ALL SELECT 'd' || c_custkey, 'nowhere', 0 FROM {customer} WHERE c_custkey % 11 = 0
  UNION ALL SELECT DISTINCT 'b' || c_custkey % 40, 'z' || c_custkey % 40 % 25, 1 FROM {customer}
  UNION ALL SELECT DISTINCT 'b' || c_custkey % 40, 'x' || c_custkey % 40, 0 FROM {customer} WHERE c_custkey % 4 = 0
  UNION ALL SELECT 'z' || n_nationkey, 'r' || n_regionkey, 1 FROM {nation}
  UNION ALL SELECT 'z' || n_nationkey, 'l' || n_nationkey % 3, 0 FROM {nation} WHERE n_nationkey % 4 = 0
  UNION ALL SELECT 'r' || r_regionkey, 'k' || r_regionkey, 0 FROM {region}
  UNION ALL SELECT 'r' || r_regionkey, 't', 1 FROM {region}
  UNION ALL SELECT 't', 'r0', 0 FROM {region} WHERE r_regionkey = 0
  UNION ALL SELECT 't', 'z3', 1 FROM {region} WHERE r_regionkey = 0
  UNION ALL SELECT 'l' || r_regionkey, 'e0', 0 FROM {region} WHERE r_regionkey < 3
  UNION ALL SELECT 'e' || n_nationkey, 'e' || (n_nationkey + 1), 0 FROM {nation} WHERE n_nationkey < 9"""
#: What each of these gives, one field a row.
_ENTITIES = """
  SELECT DISTINCT 'b' || c_custkey % 40 AS id, true AS expands, 'branch_name' AS field, CASE WHEN c_custkey % 40 % 6 = 0 THEN '' ELSE 'Branch ' || c_custkey % 40 END AS value FROM {customer}
  UNION ALL SELECT 'z' || n_nationkey, true, 'zo_name', n_name FROM {nation}
  UNION ALL SELECT 'z' || n_nationkey, true, 'zo_code', CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE 'Z' || n_nationkey END FROM {nation}
  UNION ALL SELECT 'r' || r_regionkey, true, 'nbg_name', CASE WHEN r_regionkey = 2 THEN '' ELSE r_name END FROM {region}
  UNION ALL SELECT 'k' || r_regionkey, false, 'bank_name', 'Bank ' || r_regionkey FROM {region}
  UNION ALL SELECT 'k' || r_regionkey, false, 'nbg_name', 'Group ' || r_regionkey FROM {region} WHERE r_regionkey = 3
  UNION ALL SELECT 't', true, 'ho_name', 'Head' FROM {region} WHERE r_regionkey = 0
  UNION ALL SELECT 'l' || r_regionkey, true, 'lho_name', 'Local ' || r_regionkey FROM {region} WHERE r_regionkey < 3
  UNION ALL SELECT 'e' || n_nationkey, true, 'e_name', 'e' || n_nationkey FROM {nation} WHERE n_nationkey < 9
  UNION ALL SELECT 'e' || n_nationkey, true, 'ho_name', 'Deep ' || n_nationkey FROM {nation} WHERE n_nationkey BETWEEN 4 AND 9"""
_HOLDERS = """
  SELECT 'd' || c_custkey AS device_id, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'c' || c_nationkey END AS customer_id, 'zo_name' AS field,
    CASE WHEN c_custkey % 9 = 0 THEN 'Own zone' ELSE '' END AS value FROM {customer}
  UNION ALL SELECT 'd' || c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'c' || c_nationkey END, 'nbg_name', CASE WHEN c_custkey % 8 = 0 THEN 'Own group' END FROM {customer}
  UNION ALL SELECT 'd' || c_custkey, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'c' || c_nationkey END, 'branch_name', 'Own branch' FROM {customer} WHERE c_custkey % 16 = 0"""
_CUSTOMERS = """
  SELECT 'c' || n_nationkey AS customer_id, r_name AS bank_name, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE 'Group of ' || n_name END AS nbg_name
  FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""
_HIERARCHY_FIELDS = ("bank_name", "ho_name", "nbg_name", "lho_name", "zo_name", "zo_code", "ro_name", "co_name", "rbo_name", "branch_name")


def _plain(text: str) -> str:
    return text.replace("{", "").replace("}", "")


@query(f"""WITH RECURSIVE relations AS ({_plain(_RELATIONS)}), entities AS ({_plain(_ENTITIES)}), holders AS ({_plain(_HOLDERS)}), givers AS ({_plain(_CUSTOMERS)}),
  steps AS (SELECT child, parent, ord, parent IN (SELECT id FROM entities WHERE expands) AS expands FROM relations WHERE parent IN (SELECT id FROM entities)),
  own AS (SELECT device_id, customer_id, map_from_entries(list((field, value)) FILTER (coalesce(value, '') <> '')) AS f FROM holders GROUP BY ALL),
  walk AS (SELECT device_id, parent AS node, [lpad(CAST(ord AS VARCHAR), 3, '0') || parent] AS path, expands FROM own JOIN steps ON child = device_id WHERE f['nbg_name'] IS NULL OR f['branch_name'] IS NULL
    UNION ALL SELECT device_id, parent, list_append(path, lpad(CAST(ord AS VARCHAR), 3, '0') || parent), s.expands FROM walk w JOIN steps s ON child = node WHERE w.expands AND len(path) < 8),
  named AS (SELECT device_id, field, value FROM walk JOIN entities ON id = node QUALIFY row_number() OVER (PARTITION BY device_id, field ORDER BY path) = 1),
  found AS (SELECT own.device_id, customer_id, {", ".join(f"coalesce(any_value(f['{c}']), max(nullif(value, '')) FILTER (field = '{c}')) AS {c}" for c in _HIERARCHY_FIELDS)}
    FROM own LEFT JOIN named USING (device_id) GROUP BY ALL),
  merged AS (SELECT device_id, {", ".join(
    f"CASE WHEN found.nbg_name IS NULL AND g.customer_id IS NOT NULL THEN nullif(g.{c}, '') ELSE found.{c} END AS {c}" if c in ("bank_name", "nbg_name") else c for c in _HIERARCHY_FIELDS
  )} FROM found LEFT JOIN givers g USING (customer_id))
  SELECT device_id, {", ".join(_HIERARCHY_FIELDS)}, concat_ws(' → ', {", ".join(hierarchy.PATH_LEVELS)}) AS full_path,
    CAST({" + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in hierarchy.PATH_LEVELS)} AS INTEGER) AS hierarchy_depth FROM merged""")
def join_hier_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own attributes, then a walk over relations, then the customer, as the path of every device."""
    read = lambda text: sql(spark, sf_dir, text)
    fields = F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields")
    devices = read(_HOLDERS).groupBy("device_id", "customer_id").agg(fields)
    entities = read(_ENTITIES).groupBy("id", "expands").agg(fields)
    merged = hierarchy.merge_hierarchy(devices, read(_RELATIONS), entities, read(_CUSTOMERS))
    return merged.select("device_id", *(F.try_element_at("fields", F.lit(c)).alias(c) for c in _HIERARCHY_FIELDS), "full_path", "hierarchy_depth")


# ---- metrics ------------------------------------------------------------------------------------------------------

_CURVE = """v AS (SELECT CAST(device_id AS INTEGER) % 5 AS fold, probability, sum(y) AS pos, count(*) AS n FROM scored GROUP BY ALL),
  c AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS seen, sum(pos) OVER (PARTITION BY fold) AS p, sum(n) OVER (PARTITION BY fold) AS t FROM v WINDOW w AS (PARTITION BY fold ORDER BY probability DESC))"""


@query(f"""WITH {_CURVE} SELECT fold, round(sum(pos * (tp / seen)) / max(p), 6) AS average_precision,
  round(sum(pos * ((t - p) - (seen - tp) + (n - pos) / 2)) / (max(p) * (max(t) - max(p))), 6) AS roc_auc, round(max(2 * tp / (seen + p)), 6) AS best_f1 FROM c GROUP BY 1""")
def agg_fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "scored").withColumn("fold", F.col("device_id").cast("int") % 5)
    found = metrics.ranking_metrics(rows)
    return found.select("fold", *(F.round(c, 6).alias(c) for c in ("average_precision", "roc_auc", "best_f1")))


_THRESHOLDS = [round(0.05 * k, 2) for k in range(1, 20)]
_SWEEP = f"""th AS (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in _THRESHOLDS)}]) AS threshold),
  k AS (SELECT threshold, count_if(probability >= threshold AND y = 1) AS tp, count_if(probability >= threshold AND y = 0) AS fp, count_if(probability < threshold AND y = 1) AS fn FROM scored, th GROUP BY 1),
  sw AS (SELECT *, tp / (tp + fp) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, (tp + fp) / 31.0E0 AS alerts_per_day FROM k WHERE tp + fp > 0)"""


@query(f"WITH {_SWEEP} SELECT threshold, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(alerts_per_day, 6) AS alerts_per_day FROM sw")
def agg_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.threshold_sweep(shape(spark, sf_dir, "scored"), 31.0, _THRESHOLDS)
    return found.select("threshold", "tp", "fp", "fn", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "alerts_per_day")))


@query(f"""WITH {_SWEEP} SELECT coalesce((SELECT threshold FROM sw WHERE recall >= 0.5 ORDER BY f1 DESC, threshold DESC LIMIT 1), (SELECT threshold FROM sw ORDER BY recall DESC, threshold DESC LIMIT 1)) AS recall_first,
  coalesce((SELECT threshold FROM sw WHERE alerts_per_day <= 2 ORDER BY f1 DESC, threshold DESC LIMIT 1), (SELECT threshold FROM sw ORDER BY alerts_per_day, threshold DESC LIMIT 1)) AS precision_first""")
def agg_operating_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.operating_points(metrics.threshold_sweep(shape(spark, sf_dir, "scored"), 31.0, _THRESHOLDS))


@query(f"""WITH q AS (SELECT quantile_cont(anchor_us, [0.4, 0.6, 0.8]) AS q, max(anchor_us) AS e FROM scored), c AS (SELECT list_append(q, e + 1) AS c FROM q), f AS (SELECT unnest([0, 1, 2]) AS fold),
  sides AS (SELECT arrival_seq, y, CAST(fold AS INTEGER) AS fold, CASE WHEN anchor_us < c[fold + 1] THEN 'train' ELSE 'test' END AS side FROM scored, c, f
    WHERE anchor_us < c[fold + 1] OR (anchor_us >= c[fold + 1] + {24 * HOUR_US} AND anchor_us < c[fold + 2]))
  SELECT arrival_seq, fold, side FROM sides QUALIFY sum(CASE WHEN side = 'train' THEN y END) OVER (PARTITION BY fold) > 0 AND sum(CASE WHEN side = 'test' THEN y END) OVER (PARTITION BY fold) > 0""")
def spl_timecv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.time_folds(shape(spark, sf_dir, "scored"), gap_us=24 * HOUR_US, label="y").select("arrival_seq", "fold", "side")


@query("""WITH s AS (SELECT avg(value_num) FILTER (us % 2 = 0) AS m, stddev_samp(value_num) FILTER (us % 2 = 0) AS d FROM telemetry) SELECT arrival_seq, round((value_num - m) / d, 6) AS value_num FROM telemetry, s""")
def agg_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "telemetry").select("arrival_seq", "us", "value_num")
    scaler = metrics.fit_scaler(rows.where("us % 2 = 0"), ["value_num"])
    return metrics.apply_scaler(rows, scaler, ["value_num"]).select("arrival_seq", F.round("value_num", 6).alias("value_num"))


@query("SELECT y, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM scored GROUP BY 1")
def agg_positive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = shape(spark, sf_dir, "scored").groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))  # one row per label


@query("""SELECT device_id, max_by(probability, {'a': anchor_us, 'b': arrival_seq}) AS probability FROM scored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_risk_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = shape(spark, sf_dir, "scored").groupBy("device_id").agg(F.max_by("probability", F.struct("anchor_us", "arrival_seq")).alias("probability"))
    return latest.orderBy(F.col("probability").desc_nulls_last(), "device_id").limit(10)


@query("""SELECT arrival_seq, probability, round_even(probability * 100, 1)::DOUBLE AS risk_score, CASE WHEN probability >= 0.5 THEN 'CRITICAL' WHEN probability >= 0.4 THEN 'HIGH' WHEN probability >= 0.25 THEN 'MEDIUM' ELSE 'HEALTHY' END AS tier FROM scored""")
def score_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "scored")
    return rows.select("arrival_seq", "probability", F.bround(F.col("probability") * 100, 1).alias("risk_score"), S.tier(F.col("probability")).alias("tier"))


# ---- joins and set operations -------------------------------------------------------------------------------------


@query("""SELECT device_id, name, probability, tier FROM (SELECT s.device_id, name, probability, CASE WHEN probability >= 0.5 THEN 'CRITICAL' ELSE 'OTHER' END AS tier
    FROM (SELECT device_id, max(probability) AS probability FROM scored GROUP BY 1) s JOIN devices d USING (device_id)
  UNION ALL SELECT d.device_id, name, NULL, 'NO_DATA' FROM devices d WHERE device_id NOT IN (SELECT device_id FROM scored))""")
def join_anti_nodata(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = shape(spark, sf_dir, "devices").select("device_id", "name")
    best = shape(spark, sf_dir, "scored").groupBy("device_id").agg(F.max("probability").alias("probability"))
    tier = F.when(F.col("probability") >= 0.5, "CRITICAL").otherwise("OTHER")
    rest = devices.join(best, "device_id", "left_anti").withColumn("tier", F.lit("NO_DATA"))
    return best.join(devices, "device_id").withColumn("tier", tier).unionByName(rest, allowMissingColumns=True).select("device_id", "name", "probability", "tier")


@query("SELECT t.arrival_seq, t.device_id, d.name, d.customer_id FROM telemetry t LEFT JOIN (SELECT * FROM devices WHERE key_count > 3) d USING (device_id)")
def join_left_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = shape(spark, sf_dir, "devices").where("key_count > 3").select("device_id", "name", "customer_id")
    return shape(spark, sf_dir, "telemetry").select("arrival_seq", "device_id").join(names, "device_id", "left")


@query("SELECT t.arrival_seq, t.key FROM telemetry t WHERE t.key IN (SELECT event_type FROM events WHERE value > 20 AND event_type LIKE '%r%')")
def join_semi_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = table(spark, sf_dir, "events").where("value > 20 AND event_type LIKE '%r%'").select(F.col("event_type").alias("key")).distinct()
    return shape(spark, sf_dir, "telemetry").join(allowed, "key", "left_semi").select("arrival_seq", "key")


@query("SELECT t.device_id, t.us, t.value_num, s.y FROM telemetry t JOIN scored s ON t.device_id = s.device_id AND t.us = s.anchor_us AND t.arrival_seq = s.arrival_seq WHERE s.probability >= 0.2")
def join_inner_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = shape(spark, sf_dir, "scored").where("probability >= 0.2").select("device_id", F.col("anchor_us").alias("us"), "arrival_seq", "y")
    return shape(spark, sf_dir, "telemetry").join(labels, ["device_id", "us", "arrival_seq"]).select("device_id", "us", "value_num", "y")


@query(f"SELECT d.device_id, CAST(day AS BIGINT) AS day, key FROM (SELECT DISTINCT device_id FROM telemetry) d, (SELECT unnest(range({START_DAY}, {START_DAY + 7})) AS day), (SELECT DISTINCT key FROM telemetry)")
def join_cross_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shape(spark, sf_dir, "telemetry")
    keys = t.agg(F.collect_set("key").alias("keys"))  # one row; keys are features, chosen beforehand
    days = F.explode(F.sequence(F.lit(START_DAY).cast("long"), F.lit(START_DAY + 6).cast("long"))).alias("day")
    return t.select("device_id").distinct().select("device_id", days).crossJoin(F.broadcast(keys)).select("device_id", "day", F.explode("keys").alias("key"))


@query("""WITH spec AS (SELECT unnest(['view', 'CLICK', 'net.error', 'a.b.absent', 'signup']) AS clean_key), live AS (SELECT key, count(DISTINCT device_id) AS n FROM telemetry GROUP BY 1)
  SELECT clean_key, coalesce(a.n, b.n) AS n_devices, CASE WHEN coalesce(a.n, b.n) IS NULL THEN 'NOT_POSTED' ELSE 'LIVE' END AS status
  FROM spec LEFT JOIN live a ON lower(clean_key) = lower(a.key) LEFT JOIN live b ON lower(split_part(clean_key, '.', -1)) = lower(b.key)""")
def join_manifest_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = spark.createDataFrame([(k,) for k in ("view", "CLICK", "net.error", "a.b.absent", "signup")], "clean_key string")
    live = shape(spark, sf_dir, "telemetry").groupBy(F.lower("key").alias("k")).agg(F.countDistinct("device_id").alias("n"))
    exact, tail = live.select("k", F.col("n").alias("n1")), live.select(F.col("k").alias("k2"), F.col("n").alias("n2"))
    found = spec.join(exact, F.lower("clean_key") == F.col("k"), "left").join(tail, F.lower(F.substring_index("clean_key", ".", -1)) == F.col("k2"), "left")
    n = F.coalesce("n1", "n2")
    return found.select("clean_key", n.alias("n_devices"), F.when(n.isNull(), "NOT_POSTED").otherwise("LIVE").alias("status"))


@query("""WITH c AS (SELECT device_id, max(probability) AS score FROM scored WHERE probability >= 0.9 GROUP BY 1), s AS (SELECT device_id, count(*) AS n_snapshots, count_if(evidence_type = 'lc_disconnect') AS n_offline, max(us) AS last_us FROM evidence GROUP BY 1),
  r AS (SELECT device_id, count(*) AS n_recoveries FROM alarms WHERE clear_us IS NOT NULL GROUP BY 1)
  SELECT c.device_id, score, coalesce(n_snapshots, 0) AS n_snapshots, coalesce(n_offline, 0) AS n_offline, last_us, coalesce(n_recoveries, 0) AS n_recoveries,
    CASE WHEN n_snapshots IS NULL THEN 'no_snapshots' WHEN n_offline > 0 THEN 'offline_seen' ELSE 'online_only' END AS coverage FROM c LEFT JOIN s USING (device_id) LEFT JOIN r USING (device_id)""")
def join_review_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    critical = shape(spark, sf_dir, "scored").where("probability >= 0.9").groupBy("device_id").agg(F.max("probability").alias("score"))
    snaps = shape(spark, sf_dir, "evidence").groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n_snapshots"), F.count_if(F.col("evidence_type") == "lc_disconnect").alias("n_offline"), F.max("us").alias("last_us")
    )
    cleared = shape(spark, sf_dir, "alarms").where("clear_us IS NOT NULL").groupBy("device_id").agg(F.count(F.lit(1)).alias("n_recoveries"))
    verdict = F.when(F.col("n_snapshots").isNull(), "no_snapshots").when(F.col("n_offline") > 0, "offline_seen").otherwise("online_only")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = critical.join(snaps, "device_id", "left").join(cleared, "device_id", "left")
    return joined.select("device_id", "score", zero("n_snapshots"), zero("n_offline"), "last_us", zero("n_recoveries"), verdict.alias("coverage"))


@query("SELECT DISTINCT device_id FROM evidence WHERE evidence_strength = 'weak' EXCEPT SELECT device_id FROM evidence WHERE evidence_type = 'lc_disconnect'")
def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = shape(spark, sf_dir, "evidence")
    strong = e.where("evidence_type = 'lc_disconnect'").select("device_id")
    return e.where("evidence_strength = 'weak'").select("device_id").distinct().join(strong, "device_id", "left_anti")


@query("SELECT device_id, us AS at_us, 'event' AS origin FROM evidence UNION ALL SELECT device_id, start_us, 'alarm' FROM alarms WHERE start_us IS NOT NULL")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shape(spark, sf_dir, "evidence").select("device_id", F.col("us").alias("at_us"), F.lit("event").alias("origin"))
    alarms = shape(spark, sf_dir, "alarms").where("start_us IS NOT NULL").select("device_id", F.col("start_us").alias("at_us"), F.lit("alarm").alias("origin"))
    return events.unionByName(alarms)


@query("SELECT DISTINCT device_id, alarm_type FROM alarms")
def set_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "alarms").select("device_id", "alarm_type").distinct()


@query("SELECT device_id, name FROM devices WHERE type = 'gateway' ORDER BY CAST(device_id AS BIGINT) LIMIT 25 OFFSET 10")
def lim_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "devices").where("type = 'gateway'").orderBy(F.col("device_id").cast("long")).offset(10).limit(25).select("device_id", "name")


# ---- scalar words -------------------------------------------------------------------------------------------------

_WORDS = ["offline", " OFF ", "n/a", "N/A", "", "unknown", "true", "YES", "0", "FALSE", "disconnect soon", "reconnected", "is active now", "no-data", "up", "failed_update", "bad", "healthy", "heartbeat stop", "12"]


@query("WITH w AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _WORDS) + f"""]) AS v UNION ALL SELECT NULL)
  SELECT v, v IS NULL OR lower(trim(v)) IN {_MISS} AS missing, coalesce(lower(trim(v)) NOT IN {_MISS} AND upper(trim(v)) IN ({", ".join(f"'{x}'" for x in V.FAULT)}), false) AS fault,
    coalesce(upper(trim(v)) IN ({", ".join(f"'{x}'" for x in V.AUDIT_FAULT)}), false) AS audit_fault, coalesce(lower(trim(v)) IN ('true', '1', 'yes', 'on', 'active'), false) AS yes,
    coalesce(lower(trim(v)) IN ('false', '0', 'no', 'off'), false) AS no FROM w""")
def prd_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = spark.createDataFrame([(x,) for x in [*_WORDS, None]], "v string")
    v = F.col("v")
    return w.select(
        "v", S.is_missing(v).alias("missing"), S.is_fault_word(v).alias("fault"), S.is_audit_fault(v).alias("audit_fault"),
        S.says_true(v).alias("yes"), S.says_false(v).alias("no"),
    )


@query("WITH w AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _WORDS) + f"""]) AS v)
  SELECT v, CASE WHEN lower(trim(v)) IN ({", ".join(f"'{x}'" for x in V.OFFLINE_STATES)}) THEN 'offline' WHEN lower(trim(v)) IN ({", ".join(f"'{x}'" for x in V.ONLINE_STATES)}) THEN 'online'
    WHEN regexp_matches(v, '{V.OFFLINE_TEXT}') THEN 'offline' WHEN regexp_matches(v, '{V.ONLINE_TEXT}') AND NOT contains(lower(v), 'disconnect') THEN 'online' ELSE 'unknown' END AS state FROM w""")
def prd_classify_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(x,) for x in _WORDS], "v string").select("v", S.state_of(F.col("v")).alias("state"))


@query("SELECT device_id, regexp_matches(name, '^Customer#[0-9]+$') AND lower(trim(bank)) NOT IN ('', 'none') AS is_real FROM devices")
def prd_is_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "devices").select("device_id", (F.col("name").rlike("^Customer#[0-9]+$") & ~S.is_missing(F.col("bank"))).alias("is_real"))


@query("SELECT arrival_seq, substr(sha256(concat_ws('|', device_id, key, CAST(us AS STRING))), 1, 16) AS reference FROM telemetry")
def prd_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "telemetry").select("arrival_seq", S.digest16(F.col("device_id"), F.col("key"), F.col("us").cast("string")).alias("reference"))


_URLS = ["https://u:secret@host/db", "postgres://host:5432/db?user=a&password=b&ssl=1", "jdbc:x;PWD=one;passwd=two", "https://host/a@b", "", "plain"]


@query("WITH w AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _URLS) + """, NULL]) AS url)
  SELECT url, CASE WHEN coalesce(url, '') = '' THEN '<unset>' ELSE regexp_replace(regexp_replace(url, '://[^@/]*@', '://***:***@', 'g'), '(password|passwd|pwd)=[^&;\\s]+', '\\1=***', 'gi') END AS shown FROM w""")
def prd_redact_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x in [*_URLS, None]], "url string")
    return rows.select("url", S.redacted_url(F.col("url")).alias("shown"))
