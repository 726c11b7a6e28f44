"""Queries on payloads, attributes, hierarchies, composite features and the nightly chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import DAY_US, HOUR_US
from quarry.functions.vocabulary import AUDIT_FAULT
from quarry.operators import grid, hierarchy, metrics, outages, payloads, quality, scoring, splits, trailing
from quarry.sources.tables import shape, sql, table

from .features import _OBSERVED, KEYS, START_US, STEP_US, WINDOWS, _rounded
from .labels import _CUTS, _GROUPED, _ROWS, _labels_sql, _split_rows, lbl_samples
from .registry import ORACLES, query

# ---- payloads -----------------------------------------------------------------------------------------------------

_CARDS = ['[{"sd_status":"ok","free_space":1024,"used_space":"2048"},{"sd_status":" FULL ","free_space":"x"}]', '{"sd_status":"missing","free_space":512}', "[]", "not json", '[{"sd_status":"0"},{"used_space":10}]']
_ROCKS = ['{"healthyStatus":" Unhealthy ","DahuaNVR_Heartbeat":"DahuaNVR_OFF","SdCardINFO":[{"TotalBytes":"NA"},{"TotalBytes":"5"},{}]}', '{"healthyStatus":"healthy","HddINFO":[{"TotalBytes":"n/a"}]}', "[1]", '{"SdCardINFO":[]}']
_BAS = ['{"basMainInfo":{"heartbeat":" online ","panelState":"Armed"},"basPowerStatus":{"mainStatus":"on","batteryStatus":"low"},"zoneInfo":[{"zoneEvent":"Triggered"},{"zoneEvent":"normal"},{"zoneEvent":"alarm"}]}', '{"zoneInfo":[]}', "x", '{"basMainInfo":{"heartbeat":"offline"}}']
_USAGE = ['[{"Date":"d","usage":"5"},{"usage_mb":7.5}]', '{"total":"12"}', "3.25", "nan", "[4, 9]", "[]", '[{"x":"no","y":"8"}]', '{"other":1}']


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _texts(spark: SparkSession, sf_dir: str, values: list[str]) -> DataFrame:
    pick = F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", pick.alias("payload"))


def _payload_sql(values: list[str]) -> str:
    return f"e AS (SELECT event_id, {_sql_list(values)}[event_id % {len(values)} + 1] AS p FROM events), j AS (SELECT event_id, p, CASE WHEN json_valid(p) THEN p::JSON END AS j FROM e)"


def _expected(values: list[str], columns: dict[str, list]) -> str:
    """The answer for each payload, worked out by hand, as a join on the payload's number."""
    def lit(v: object) -> str:
        return "NULL" if v is None else "'" + v + "'" if isinstance(v, str) else f"{v!r}::DOUBLE" if isinstance(v, float) else f"{v}::INTEGER"

    rows = ", ".join("(" + ", ".join([str(k), *(lit(columns[c][k]) for c in columns)]) + ")" for k in range(len(values)))
    return f"SELECT event_id, {', '.join(columns)} FROM events JOIN (VALUES {rows}) v(k, {', '.join(columns)}) ON event_id % {len(values)} = k"


@query(_expected(_CARDS, {"n_cards": [2, 1, 0, 0, 2], "n_bad": [1, 1, 0, 0, 1], "free_gb": [1.0, 0.5, 0.0, 0.0, 0.0], "used_gb": [2.0, 0.0, 0.0, 0.0, 10 / 1024]}))
def parse_sd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, _CARDS).select("event_id", payloads.storage_cards(F.col("payload")).alias("s")).select("event_id", "s.*")


@query(_expected(_ROCKS, {"health": ["unhealthy", "healthy", "", ""], "unhealthy": [1, 0, 0, 0], "recorder_off": [1, 0, 0, 0], "n_cameras": [3, 1, 0, 0], "n_without_card": [2, 1, 0, 0]}))
def parse_rock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, _ROCKS).select("event_id", payloads.rock_summary(F.col("payload")).alias("s")).select("event_id", "s.*")


@query(_expected(_BAS, {"heartbeat": ["online", "", "", "offline"], "panel_state": ["Armed", "", "", ""], "main_status": ["on", "", "", ""], "battery_status": ["low", "", "", ""], "n_zone_events": [2, 0, 0, 0]}))
def parse_bas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, _BAS).select("event_id", payloads.bas_summary(F.col("payload")).alias("s")).select("event_id", "s.*")


@query(_expected(_USAGE, {"usage": [7.5, 12.0, 3.25, None, 9.0, None, 8.0, None]}))
def parse_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, _USAGE).select("event_id", payloads.latest_usage(F.col("payload")).alias("usage"))


_ATTRIBUTES = """SELECT CAST(user_id AS STRING) AS device_id, CASE event_id % 4 WHEN 0 THEN 'SHARED_SCOPE' WHEN 1 THEN 'CLIENT_SCOPE' WHEN 2 THEN 'SERVER_SCOPE' ELSE 'OTHER' END AS scope,
  event_type AS key, CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'v' || CAST(event_id AS STRING) END AS value, [us ts] AS last_update_us FROM {events}"""


@query(f"""WITH a AS ({_ATTRIBUTES}), b AS (SELECT * FROM a WHERE value IS NOT NULL AND key IN ('view', 'click', 'error') QUALIFY row_number() OVER (PARTITION BY device_id, key
    ORDER BY CASE scope WHEN 'SERVER_SCOPE' THEN 1 WHEN 'CLIENT_SCOPE' THEN 2 WHEN 'SHARED_SCOPE' THEN 3 ELSE 4 END, last_update_us DESC) = 1)
  SELECT device_id, max(value) FILTER (key = 'view') AS view, max(value) FILTER (key = 'click') AS click, max(value) FILTER (key = 'error') AS error FROM b GROUP BY 1""".replace("{events}", "events"))
def src_nb_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.merged_attributes(sql(spark, sf_dir, _ATTRIBUTES), ["view", "click", "error"])


_WIDE = """SELECT CAST(user_id AS STRING) AS device_id, CASE WHEN user_id % 3 = 0 THEN 'false' WHEN user_id % 3 = 1 THEN 'true' END AS active, CASE WHEN user_id % 5 = 0 THEN 'Disconnected' ELSE 'ok' END AS status,
  CASE WHEN user_id % 7 = 0 THEN 'null' ELSE 'Off' END AS state, min(CASE WHEN event_type = 'error' THEN [us ts] END) AS inactive_since, min(CASE WHEN event_type = 'signup' AND user_id % 2 = 0 THEN [us ts] END) AS last_disconnect,
  CAST(NULL AS BIGINT) AS inactivity_alarm, CASE WHEN user_id % 4 = 0 THEN max([us ts]) END AS last_activity FROM {events} GROUP BY user_id"""


@query(f"WITH w AS ({_WIDE.replace('{events}', 'events')}) SELECT device_id, coalesce(inactive_since, last_disconnect, inactivity_alarm, last_activity) AS outage_start, 'low' AS confidence FROM w WHERE (active = 'false' OR status = 'Disconnected') AND coalesce(inactive_since, last_disconnect, inactivity_alarm, last_activity) IS NOT NULL")
def win_current_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.current_outage(sql(spark, sf_dir, _WIDE))


@query(f"""WITH w AS ({_WIDE.replace('{events}', 'events')}), s AS (SELECT device_id, coalesce(nullif(status, ''), nullif(state, 'null'), active) AS status FROM w)
  SELECT device_id, status, lower(status) IN ('offline', 'off', 'down', 'disconnected', '0', 'false') AS is_offline FROM s""")
def prj_device_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.device_state(sql(spark, sf_dir, _WIDE))


# ---- hierarchy ----------------------------------------------------------------------------------------------------

_MAPPING = [("EUROPE", "BUILDING", "zo", 1), (None, "BUILDING", "branch", 2), (None, "AUTO", "ro", 3), (None, "MACHINE", "_ignore", 4), (None, "HOUSE", "ho", 5)]


@query("""WITH m(org, t, level, priority) AS (VALUES """ + ", ".join(f"({'NULL' if o is None else repr(o)}, '{t}', '{lv}', {p})" for o, t, lv, p in _MAPPING) + """),
  a AS (SELECT device_id, bank, coalesce(branch, 'nothing') AS asset_type FROM devices)
  SELECT device_id, coalesce((SELECT level FROM m WHERE org IS NOT NULL AND t = asset_type AND contains(lower(bank), lower(org))), (SELECT level FROM m WHERE org IS NULL AND t = asset_type),
    (SELECT min_by(level, priority) FROM m WHERE org IS NULL AND level <> '_ignore' AND contains(lower(asset_type), lower(t))), 'other') AS level FROM a""")
def prj_hier_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = spark.createDataFrame(_MAPPING, "org string, asset_type string, level string, priority int")
    assets = shape(spark, sf_dir, "devices").select("device_id", "bank", F.coalesce("branch", F.lit("nothing")).alias("asset_type"))
    return hierarchy.asset_levels(assets, mapping).select("device_id", "level")


@query("""WITH s AS (SELECT *, CAST(((CAST(round(balance) AS BIGINT) % 101) + 101) % 101 AS DOUBLE) AS score FROM devices), z AS (SELECT bank, zone, count(*) AS n, sum(score) AS t, count_if(score >= 70) AS c FROM s GROUP BY ALL)
  SELECT bank, CAST(sum(n) AS BIGINT) AS n_devices, CAST(sum(c) AS BIGINT) AS n_critical, round(sum(t), 4) AS total_score, count(*) AS n_zones, min(zone) AS first_zone, max(n) AS most FROM z GROUP BY 1""")
def sink_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fleet import _scored_devices

    nodes = hierarchy.tree(_scored_devices(spark, sf_dir), ["bank", "zone"])
    children, summary = F.col("node.children"), F.col("node.summary")
    return nodes.select(
        "bank", summary["n_devices"].alias("n_devices"), summary["n_critical"].alias("n_critical"), F.round(summary["total_score"], 4).alias("total_score"),
        F.size(children).cast("long").alias("n_zones"), children[0]["name"].alias("first_zone"),
        F.array_max(F.transform(children, lambda c: c["summary"]["n_devices"])).alias("most"),
    )


# ---- composites ---------------------------------------------------------------------------------------------------


_SPARSE = """SELECT device_id, key, us, arrival_seq, CASE WHEN arrival_seq % 7 <> 3 THEN value_num END AS value_num FROM {telemetry}"""


def _anomaly_sql(streak_keys: int = 3) -> str:
    per_key = ", ".join(
        f"max(last) FILTER (key = '{k}') AS {k}__last, max(last_age_h) FILTER (key = '{k}') AS {k}__last_age_h, max(stale) FILTER (key = '{k}') AS {k}__stale, "
        + ", ".join(f"max(count_{h}h) FILTER (key = '{k}') AS {k}__count_{h}h" for h in WINDOWS) + ", "
        + ", ".join(f"round(max({s}_{h}h) FILTER (key = '{k}'), 6) AS {k}__{s}_{h}h" for h in WINDOWS for s in ("mean", "std", "min", "max"))
        + f", max(z) FILTER (key = '{k}') AS {k}__z24h_vs_28d, max(gap) FILTER (key = '{k}') AS {k}__gap_max_7d"
        for k in KEYS
    )
    value = lambda h: f"CASE WHEN r.us >= a.anchor_us - {h * HOUR_US} THEN value_num END"
    windows = ", ".join(
        f"CASE WHEN count(value_num) > 0 {'OR count(r.us) > 0' if h == 1 else ''} THEN count({value(h)}) END AS count_{h}h, avg({value(h)}) AS mean_{h}h, "
        f"CASE WHEN count({value(h)}) = 1 THEN 0.0 ELSE stddev_samp({value(h)}) END AS std_{h}h, min({value(h)}) AS min_{h}h, max({value(h)}) AS max_{h}h" for h in WINDOWS
    )
    age = f"(a.anchor_us - max(r.us)) / {float(HOUR_US)}"
    return f"""WITH sparse AS ({_SPARSE.replace("{telemetry}", "telemetry")}), own AS (SELECT device_id, min(us) + {12 * HOUR_US} AS start_us, max(us) AS end_us FROM sparse GROUP BY 1),
  da AS (SELECT device_id, unnest(generate_series(start_us - start_us % {STEP_US}, end_us, {STEP_US})) AS anchor_us FROM own), a AS (SELECT * FROM da CROSS JOIN (SELECT unnest({KEYS}) AS key)),
  long AS (SELECT a.device_id, a.key, a.anchor_us, {windows}, count(r.us) AS n_rows, max(r.us) AS row_us, CASE WHEN count(value_num) > 0 THEN {age} END AS last_age_h,
      CASE WHEN {age} <= 6 THEN arg_max(value_num, {{'a': r.us, 'b': arrival_seq}}) FILTER (value_num IS NOT NULL) END AS last, CAST(CASE WHEN count(value_num) > 0 THEN CASE WHEN {age} > 6 THEN 1 ELSE 0 END END AS INTEGER) AS stale
    FROM a LEFT JOIN sparse r ON a.device_id = r.device_id AND a.key = r.key AND r.us <= a.anchor_us GROUP BY a.device_id, a.key, a.anchor_us),
  {_OBSERVED.replace("FROM telemetry", "FROM sparse")},
  n AS (SELECT a.*, o.us AS r_us, o.recent FROM a ASOF LEFT JOIN observed o ON a.device_id = o.device_id AND a.key = o.key AND a.anchor_us >= o.us),
  cuts AS (SELECT *, anchor_us - {24 * HOUR_US} AS cut FROM n),
  j AS (SELECT s.*, o.us AS j_us, o.base_mean, o.base_sd, o.base_n FROM cuts s ASOF LEFT JOIN observed o ON s.device_id = o.device_id AND s.key = o.key AND s.cut >= o.us),
  zs AS (SELECT device_id, key, anchor_us, CASE WHEN r_us >= cut AND r_us > j_us AND base_n >= 10 THEN round(greatest(-50.0, least(50.0, (recent - base_mean) / greatest(coalesce(base_sd, 0.0), greatest(abs(base_mean), 1.0) * 1e-3))), 6) END AS z FROM j),
  busy AS (SELECT device_id, key FROM sparse GROUP BY device_id, key QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY count(*) DESC, key) <= {streak_keys}),
  gaps AS (SELECT device_id, key, us, (us - lag(us) OVER (PARTITION BY device_id, key ORDER BY us)) / {float(HOUR_US)} AS gap_h FROM sparse JOIN busy USING (device_id, key) WHERE value_num IS NOT NULL),
  worst AS (SELECT *, max(gap_h) OVER (PARTITION BY device_id, key ORDER BY us RANGE BETWEEN {7 * DAY_US - 1} PRECEDING AND CURRENT ROW) AS most FROM gaps WHERE gap_h IS NOT NULL),
  gs AS (SELECT a.*, CASE WHEN w.us >= a.anchor_us - {7 * DAY_US} THEN round(most, 6) END AS gap FROM a ASOF LEFT JOIN worst w ON a.device_id = w.device_id AND a.key = w.key AND a.anchor_us >= w.us)
  SELECT device_id, anchor_us, {per_key}, max(row_us) AS max_source_us, CAST(sum(n_rows) AS BIGINT) AS n_rows_used, true AS feature_ready
  FROM long JOIN zs USING (device_id, key, anchor_us) JOIN gs USING (device_id, key, anchor_us) GROUP BY device_id, anchor_us"""


def anomaly_features(readings: DataFrame, keys: list[str], *, streak_keys: int = 10, min_history_h: int = 12) -> DataFrame:
    """The wide anomaly features per device and anchor, from ``min_history_h`` after a device's first reading to its last."""
    known = readings.where(F.col("key").isin(keys))
    first = F.min("us") + min_history_h * HOUR_US
    bounds = known.groupBy("device_id").agg((first - first % STEP_US).alias("start_us"), F.max("us").alias("end_us"))
    anchors = trailing.grid(bounds, STEP_US).withColumn("key", F.explode(F.array(*map(F.lit, keys))))
    long = trailing.own_norm_features(anchors, known, WINDOWS, streak_keys=streak_keys)
    long = long.withColumnsRenamed({"z": "z24h_vs_28d", "gap_max_h": "gap_max_7d"})
    values = ["last", "last_age_h", "stale"] + [f"count_{h}h" for h in WINDOWS] + [f"{s}_{h}h" for h in WINDOWS for s in ("mean", "std", "min", "max")]
    extra = [F.max("row_us").alias("max_source_us"), F.sum("rows_total").alias("n_rows_used"), F.lit(True).alias("feature_ready")]
    return trailing.pivot_features(long, keys, [*values, "z24h_vs_28d", "gap_max_7d"], extra=extra)


@query(_anomaly_sql())
def agg_anomaly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(anomaly_features(sql(spark, sf_dir, _SPARSE), KEYS, streak_keys=3))


@query("SELECT device_id, max(CASE WHEN y = 1 THEN 1 ELSE 0 END)::INTEGER AS y, count(*) AS n FROM scored GROUP BY 1")
def lbl_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    positive = F.when(F.col("y") == 1, 1).otherwise(0)
    return shape(spark, sf_dir, "scored").groupBy("device_id").agg(F.max(positive).alias("y"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH r AS (SELECT event_id, [us ts] AS us, row_number() OVER (ORDER BY ts, event_id) AS k, count(*) OVER () AS n FROM events),
  s AS (SELECT event_id, us, CASE WHEN k <= round_even(n * 0.7E0, 0) THEN 'train' WHEN k <= round_even(n * 0.85E0, 0) THEN 'validation' ELSE 'test' END AS split FROM r),
  b AS (SELECT (max(us) FILTER (split = 'train') + min(us) FILTER (split = 'validation')) / 2.0E0 AS b1, (max(us) FILTER (split = 'validation') + min(us) FILTER (split = 'test')) / 2.0E0 AS b2 FROM s), h AS (SELECT {24 * HOUR_US} AS h)
  SELECT event_id, CASE WHEN split = 'train' AND us > b1 - h OR split = 'validation' AND (us < b1 + h OR us > b2 - h) OR split = 'test' AND us < b2 + h THEN 'purged' ELSE split END AS split FROM s, b, h""")
def spl_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, "SELECT event_id, [us ts] AS us FROM {events}")
    return splits.purge(splits.time_splits(rows, by=["us", "event_id"]), 24, time="us").select("event_id", "split")


@query("""WITH RECURSIVE d AS (SELECT device_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, device_id) AS place FROM scored GROUP BY 1),
  g AS (SELECT 0::BIGINT AS place, NULL::VARCHAR AS device_id, -1 AS fold, [0, 0, 0, 0, 0]::BIGINT[] AS load UNION ALL
    SELECT d.place, d.device_id, CAST(least_ - 1 AS INTEGER), list_transform(load, lambda x, i: x + CASE WHEN i = least_ THEN n ELSE 0 END) FROM (SELECT *, list_position(load, list_min(load)) AS least_ FROM g) p JOIN d ON d.place = p.place + 1)
  SELECT device_id, fold FROM g WHERE place > 0""")
def spl_groupkfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.group_folds(shape(spark, sf_dir, "scored"), "device_id")


@query("SELECT 'value_num' AS name, count(DISTINCT value_num) <= 1 AS constant FROM telemetry UNION ALL SELECT 'one', true")
def agg_const_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "telemetry").select("value_num", F.lit(1).alias("one"))
    constant = metrics.constant_columns(rows, rows.columns)
    return spark.createDataFrame([(c, c in constant) for c in rows.columns], "name string, constant boolean")


@query(ORACLES["score_ts_row"].replace("SELECT row_id, score, severity, reasons FROM scored_days", "SELECT row_id, len(string_split(reasons, ' | ')) AS n_reasons, string_split(reasons, ' | ')[1] AS first_reason FROM scored_days"))
def top_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fleet import score_ts_row

    said = F.split("reasons", r" \| ")
    return score_ts_row(spark, sf_dir).select("row_id", F.size(said).cast("long").alias("n_reasons"), said[0].alias("first_reason"))


@query("SELECT device_id, bank, name FROM devices WHERE key_count > 10 ORDER BY bank, name, device_id")
def srt_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "devices").where("key_count > 10").orderBy("bank", "name", "device_id").select("device_id", "bank", "name")


def _turns(by: int, *values: str | None) -> str:
    """A value of the list for devices whose number leaves its place as remainder, else null."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE k % {by} {cases} END"


#: every input of the audit's rules, faulty, sound, odd and missing in turns
_AUDITED = {
    "gap_days": "CASE WHEN k % 4 = 0 THEN CAST(k % 100 AS STRING) WHEN k % 4 = 1 THEN 'n.a.' END",
    "bas_downtime_min": "CASE WHEN k % 5 = 0 THEN CAST(k * 37 % 2000 AS STRING) END",
    "total_data_mb": "CASE WHEN k % 10 = 0 THEN '0' WHEN k % 11 > 0 THEN '7.5' END",
    "inactive_since": _turns(13, "2026-01-01", "null", "", "None"),
    "nvr_status": _turns(17, "FAULT", "N/A", " offline ", "ok", None, "online"), "flag_dvr_off": _turns(7, "true", "false", "0", "null"),
    "hdd_status": _turns(19, "error", "healthy"), "flag_hdd_error": _turns(11, "1", "FALSE", ""),
    "flag_power_off": _turns(16, "yes", "0"), "gw_status": _turns(9, "DOWN", "up"),
    "camera_disconnects": "CASE WHEN k % 6 = 0 THEN CAST(k % 8 AS STRING) END", "flag_camera_disconnect": _turns(14, "true", "false"),
    "fas_status": _turns(23, "FAILED", "normal"), "flag_fas_off": _turns(12, "true"), "flag_fas_fault": _turns(8, "true", "null"),
    "ias_status": _turns(21, "0", "1"), "flag_ias_off": _turns(25, "true", "false"),
    "integrated_status": _turns(22, "inactive", "active"), "flag_integrated_off": _turns(15, "x"),
    "acs_status": _turns(27, "disconnected", "fine"), "bas_status": _turns(26, "FAILED_UPDATE"),
    "tls_status": _turns(29, "false", "true"), "flag_tls_off": _turns(28, "true"),
    "flag_battery_low": _turns(18, "true", "0"), "flag_battery_reverse": _turns(20, "true", "0"),
    "fw_state": _turns(24, "failed", "UPDATED", "ERROR"), "disk": "CASE WHEN k % 3 = 0 THEN CAST(60 + k % 40 AS STRING) END",
    "cpu": "CASE WHEN k % 3 = 1 THEN CAST(80 + k % 20 AS STRING) END",
}
_AUDIT_INPUT = f"SELECT device_id, {', '.join(f'{e} AS {c}' for c, e in _AUDITED.items())} FROM (SELECT device_id, CAST(device_id AS BIGINT) AS k FROM {{devices}})"


def _audit_sql() -> str:
    fault = lambda c: f"upper(trim({c})) IN ({', '.join(repr(w) for w in AUDIT_FAULT)})"
    flag = lambda c: f"NOT coalesce(lower({c}) IN ('false', '0', '', 'null'), true)"
    n = lambda c: f"coalesce(TRY_CAST({c} AS DOUBLE), 0)"
    said = lambda points, label: (str(points), f"'{label}(+{points})'")
    whole = lambda c: f"CAST({n(c)} AS BIGINT)"
    percent = lambda c, label: f"'{label}(' || {whole(c)} || '%)'"
    ladders = [
        [(f"{n('gap_days')} >= {d}", *said(p, f"GAP_{d}D")) for d, p in ((90, 50), (30, 40), (7, 25), (3, 12))],
        [(f"{n('bas_downtime_min')} >= {d}", *said(p, f"BAS_DT_{d}M")) for d, p in ((1440, 30), (480, 20), (60, 10))],
        [(f"{n('total_data_mb')} = 0", *said(15, "ZERO_DATA"))],
        [("inactive_since NOT IN ('', 'null', 'None')", *said(20, "INACTIVE"))],
        [(fault("nvr_status"), *said(30, "NVR_FAULT")), (flag("flag_dvr_off"), *said(28, "DVR_OFF"))],
        [(fault("hdd_status"), *said(30, "HDD_FAULT")), (flag("flag_hdd_error"), *said(25, "HDD_ERROR"))],
        [(flag("flag_power_off"), *said(20, "POWER_OFF")), (fault("gw_status"), *said(15, "GW_FAULT"))],
        [
            (f"{n('camera_disconnects')} > 0", f"least(5 * {n('camera_disconnects')}, 25)", f"'CAM_DC=' || {whole('camera_disconnects')} || '(+' || least(5 * {whole('camera_disconnects')}, 25) || ')'"),
            (flag("flag_camera_disconnect"), *said(15, "CAM_DISCONNECT")),
        ],
        [(fault("fas_status"), *said(20, "FAS_FAULT")), (flag("flag_fas_off"), *said(20, "FAS_OFF")), (flag("flag_fas_fault"), *said(18, "FAS_FLAG"))],
        [(f"{fault('ias_status')} OR {flag('flag_ias_off')}", *said(15, "IAS_FAULT"))],
        [(fault("integrated_status"), *said(15, "INT_FAULT")), (flag("flag_integrated_off"), *said(15, "INT_OFF"))],
        [(fault("acs_status"), *said(15, "ACS_FAULT"))],
        [(fault("bas_status"), *said(12, "BAS_FAULT"))],
        [(f"{fault('tls_status')} OR {flag('flag_tls_off')}", *said(10, "TLS_FAULT"))],
        [(flag("flag_battery_low"), *said(10, "BATT_LOW"))],
        [(flag("flag_battery_reverse"), *said(8, "BATT_REVERSE"))],
        [("upper(fw_state) IN ('FAILED', 'FAILED_UPDATE', 'ERROR')", *said(10, "FW_FAIL"))],
        [(f"{n('disk')} >= {least}", str(p), percent("disk", label)) for least, p, label in ((90, 20, "DISK_CRIT"), (80, 15, "DISK_HIGH"), (75, 8, "DISK_WARN"))],
        [(f"{n('cpu')} >= 90", "10", percent("cpu", "CPU_HIGH"))],
    ]
    rules = ["CASE " + " ".join(f"WHEN {when} THEN {{'p': CAST({p} AS DOUBLE), 'r': {r}}}" for when, p, r in steps) + " END" for steps in ladders]
    return f"""WITH audited AS ({_AUDIT_INPUT.replace("{devices}", "devices")}), hits AS (SELECT device_id, list_filter([{", ".join(rules)}], lambda x: x IS NOT NULL) AS h FROM audited),
  sums AS (SELECT device_id, least(100.0::DOUBLE, coalesce(list_sum(list_transform(h, lambda x: x.p)), 0)) AS score, array_to_string(list_transform(h[1:6], lambda x: x.r), ' | ') AS said FROM hits)
  SELECT device_id, score, CASE WHEN score >= 70 THEN 'CRITICAL' WHEN score >= 45 THEN 'HIGH' WHEN score >= 20 THEN 'MEDIUM' ELSE 'HEALTHY' END AS severity, CASE WHEN said = '' THEN 'OK' ELSE said END AS reasons FROM sums"""


@query(_audit_sql())
def score_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_audit(sql(spark, sf_dir, _AUDIT_INPUT)).select("device_id", "score", "severity", "reasons")


@query(f"""WITH s AS (SELECT device_id, bool_or(completeness IN ('complete', 'empty_verified')) AS covered, max(newest_us) FILTER (completeness IN ('complete', 'empty_verified')) AS newest_us FROM ledger GROUP BY 1)
  SELECT d.device_id, CASE WHEN NOT coalesce(covered, false) THEN 'no_label_source_coverage_for_device' WHEN {START_US + 31 * DAY_US} - newest_us > {2 * DAY_US} THEN 'label_source_history_stale' END AS reason FROM devices d LEFT JOIN s USING (device_id)""")
def join_coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = outages.coverage_verdicts(shape(spark, sf_dir, "ledger"), START_US + 31 * DAY_US, min_days=2)
    joined = shape(spark, sf_dir, "devices").select("device_id").join(verdicts, "device_id", "left")
    reason = F.when(~F.coalesce("covered", F.lit(False)), "no_label_source_coverage_for_device").when(F.col("stale"), "label_source_history_stale")
    return joined.select("device_id", reason.alias("reason"))


@query(f"WITH {_CUTS}, {_ROWS} SELECT event_id, split FROM rows_")
def src_features_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = sql(spark, sf_dir, _GROUPED).select("event_id")
    return features.join(_split_rows(spark, sf_dir).select("event_id", "split"), "event_id")


@query(f"WITH {_labels_sql(True)} SELECT label_status, censor_reason, count(*) AS n FROM final GROUP BY ALL")
def agg_label_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl_samples(spark, sf_dir).groupBy("label_status", "censor_reason").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT device_id, max_by(probability, {'a': anchor_us, 'b': arrival_seq}) AS probability FROM scored GROUP BY 1), k AS (SELECT device_id FROM devices WHERE customer_id IS NOT NULL AND lower(type) NOT IN ('test', 'demo', 'simulator', 'synthetic'))
  SELECT k.device_id, probability, CASE WHEN probability IS NULL THEN 'NO_DATA' WHEN probability >= 0.5 THEN 'CRITICAL' WHEN probability >= 0.4 THEN 'HIGH' WHEN probability >= 0.25 THEN 'MEDIUM' ELSE 'HEALTHY' END AS tier FROM k LEFT JOIN s USING (device_id)""")
def nightly_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible devices with the tier of their latest score, and those without one as NO_DATA."""
    from quarry.functions.scalars import tier

    eligible = quality.decide_devices(shape(spark, sf_dir, "devices"), names=[], require_customer=True).where("keep").select("device_id")
    scored = shape(spark, sf_dir, "scored").groupBy("device_id").agg(
        F.max_by("probability", F.struct("anchor_us", "arrival_seq")).alias("probability")
    )
    known = scored.join(eligible, "device_id", "left_semi").withColumn("tier", tier(F.col("probability")))
    rest = eligible.join(scored, "device_id", "left_anti").withColumn("tier", F.lit("NO_DATA"))
    return known.unionByName(rest, allowMissingColumns=True)
