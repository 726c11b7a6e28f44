"""Queries on evidence, outages, labels and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import DAY_US, HOUR_US
from quarry.functions.vocabulary import CAMERA_CHANNEL
from quarry.operators import outages, splits, trailing
from quarry.sources.tables import shape, sql

from .features import START_US
from .registry import query

END_US = START_US + 31 * DAY_US

_WINDOWS = """marks AS (SELECT *, evidence_type = 'lc_disconnect' AS off_, evidence_type = 'lc_connect' AS on_ FROM evidence WHERE evidence_strength = 'strong'),
  islands AS (SELECT *, coalesce(sum(CAST(on_ AS INTEGER)) OVER (PARTITION BY device_id ORDER BY us, arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM marks),
  pairs AS (SELECT device_id, k, min(us) FILTER (off_) AS outage_start, max(us) FILTER (on_) AS outage_end FROM islands GROUP BY ALL),
  windows AS (SELECT device_id, outage_start, outage_end, (outage_end - outage_start) / 60000000.0E0 AS duration_minutes, outage_end IS NOT NULL AS window_closed
    FROM pairs WHERE outage_start IS NOT NULL AND (outage_end IS NULL OR outage_end - outage_start >= 300000000))"""


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = shape(spark, sf_dir, "evidence").where("evidence_strength = 'strong'")
    return outages.outage_windows(strong, F.col("evidence_type") == "lc_disconnect", F.col("evidence_type") == "lc_connect")


@query(f"WITH {_WINDOWS} SELECT * FROM windows")
def win_outage_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir)


@query(f"WITH {_WINDOWS} SELECT * FROM windows WHERE window_closed")
def lbl_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir).where("window_closed")


@query("""WITH marks AS (SELECT CAST(user_id AS STRING) AS device_id, CASE WHEN value < 30 THEN 'a' ELSE 'b' END AS key, event_id, epoch_us(ts) AS us, event_type IN ('view', 'error') AS on_ FROM events),
  islands AS (SELECT *, coalesce(sum(CAST(on_ AS INTEGER)) OVER (PARTITION BY device_id, key ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM marks),
  pairs AS (SELECT device_id, key, k, min(us) FILTER (NOT on_) AS outage_start, max(us) FILTER (on_) AS outage_end FROM islands GROUP BY ALL)
  SELECT device_id, key, outage_start, outage_end, CASE WHEN outage_end IS NULL THEN 'low' ELSE 'medium' END AS confidence FROM pairs WHERE outage_start IS NOT NULL""")
def win_state_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, """
      SELECT CAST(user_id AS STRING) AS device_id, CASE WHEN value < 30 THEN 'a' ELSE 'b' END AS key, event_id AS arrival_seq, [us ts] AS us,
        CASE WHEN event_type IN ('view', 'error') THEN 'online' ELSE 'no data' END AS state_text FROM {events}""")  # fmt: skip
    state = outages.classify_state(F.col("state_text"))
    found = outages.outage_windows(rows, state == "offline", state == "online", by=("device_id", "key"), min_minutes=0)
    return found.select("device_id", "key", "outage_start", "outage_end", F.when(F.col("window_closed"), "medium").otherwise("low").alias("confidence"))


@query("""WITH marks AS (SELECT device_id, us, arrival_seq, evidence_type = 'lc_connect' AS on_ FROM evidence WHERE evidence_strength = 'strong'),
  islands AS (SELECT *, coalesce(sum(CAST(on_ AS INTEGER)) OVER (PARTITION BY device_id ORDER BY us, arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM marks),
  pairs AS (SELECT device_id, k, min(us) FILTER (NOT on_) AS outage_start, max(us) FILTER (on_) AS outage_end FROM islands GROUP BY ALL)
  SELECT device_id, outage_start, outage_end, 'high' AS confidence FROM pairs WHERE outage_start IS NOT NULL""")
def win_event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = shape(spark, sf_dir, "evidence").where("evidence_strength = 'strong'")
    found = outages.outage_windows(strong, F.col("evidence_type") == "lc_disconnect", F.col("evidence_type") == "lc_connect", min_minutes=0)
    return found.select("device_id", "outage_start", "outage_end", F.lit("high").alias("confidence"))


@query("""SELECT a.device_id, a.us AS anchor_us, min(b.us) AS next_us FROM evidence a
  LEFT JOIN evidence b ON a.device_id = b.device_id AND b.evidence_type = 'lc_connect' AND b.us > a.us
  WHERE a.evidence_type = 'lc_disconnect' GROUP BY ALL""")
def join_asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "evidence")
    down = rows.where("evidence_type = 'lc_disconnect'").select("device_id", F.col("us").alias("anchor_us"))
    return trailing.next_after(down.distinct(), rows.where("evidence_type = 'lc_connect'").select("device_id", "us"))


@query("""SELECT a.device_id, a.us AS disconnect_us, (SELECT min(b.us) FROM evidence b WHERE b.device_id = a.device_id AND b.evidence_type = 'lc_connect' AND b.us > a.us) AS connect_us
  FROM evidence a WHERE a.evidence_type = 'lc_disconnect'""")
def win_ts_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "evidence")
    down = rows.where("evidence_type = 'lc_disconnect'").select("device_id", F.col("us").alias("anchor_us"))
    found = trailing.next_after(down, rows.where("evidence_type = 'lc_connect'").select("device_id", "us"))
    return found.select("device_id", F.col("anchor_us").alias("disconnect_us"), F.col("next_us").alias("connect_us"))


@query(f"""WITH e AS (SELECT device_id, alarm_id, alarm_type, CASE WHEN regexp_matches(alarm_type, '{CAMERA_CHANNEL}') THEN 'camera' ELSE 'device' END AS scope, start_us, clear_us
    FROM alarms WHERE start_us IS NOT NULL)
  SELECT device_id, alarm_id, alarm_type, scope, 'ACTIVATED' AS state, start_us AS us FROM e
  UNION ALL SELECT device_id, alarm_id, alarm_type, scope, 'CLEARED', clear_us FROM e WHERE clear_us IS NOT NULL""")
def prj_alarm_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outages.alarms_to_events(shape(spark, sf_dir, "alarms"))


_EVENT_ROWS = """SELECT event_id, CAST(user_id AS STRING) AS device_id, CASE event_type WHEN 'error' THEN 'LC_EVENT' WHEN 'signup' THEN 'lifecycle'
    WHEN 'view' THEN 'ALARM' WHEN 'click' THEN 'ALARM_UPDATE' ELSE CASE WHEN event_id % 2 = 0 THEN 'ERROR' ELSE 'STATS' END END AS event_type,
    CASE WHEN event_type = 'error' AND event_id % 3 > 0 THEN '{"data":{"method":"onDisconnect"}}' WHEN event_type = 'error' THEN '{"method":" "}'
      WHEN event_type = 'signup' THEN '{"method":"onConnect"}' WHEN event_type = 'view' AND event_id % 3 = 0 THEN '{"alarmType":"CAMERA TAMPER CH 1"}'
      WHEN event_type = 'view' AND event_id % 3 = 1 THEN '{"alarmType":"DVR/NVR OFF"}' WHEN event_type = 'view' THEN '{"alarmType":"POWER restored"}'
      WHEN event_type = 'click' THEN '{}' WHEN event_id % 5 = 0 THEN '{"data":{"currentAttr":{"a":1}}}' ELSE 'not json' END AS payload,
    CASE WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'camera' WHEN event_type = 'click' THEN 'device' END AS scope,
    CASE WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'ACTIVATED' WHEN event_type = 'click' THEN 'CLEARED' END AS state FROM {events}"""


@query("""WITH rows_ AS (SELECT event_id, CAST(user_id AS STRING) AS device_id, event_type AS e FROM events),
  typed AS (SELECT event_id, device_id, CASE WHEN e = 'error' AND event_id % 3 > 0 THEN 'lc_disconnect' WHEN e = 'signup' THEN 'lc_connect'
      WHEN e = 'view' AND event_id % 3 = 0 THEN 'alarm_channel' WHEN e = 'view' AND event_id % 3 = 1 THEN 'alarm_offline' WHEN e = 'view' THEN 'alarm_cleared'
      WHEN e = 'click' AND event_id % 4 = 0 THEN 'alarm_channel' WHEN e = 'click' AND event_id % 2 = 0 THEN 'alarm_offline' WHEN e = 'click' THEN 'alarm_cleared'
      WHEN e = 'purchase' AND event_id % 2 = 0 THEN 'error_event' WHEN e = 'purchase' AND event_id % 5 = 0 THEN 'current_attr_snapshot' END AS evidence_type FROM rows_)
  SELECT event_id, device_id, evidence_type, CASE WHEN evidence_type IN ('lc_disconnect', 'lc_connect', 'alarm_offline', 'alarm_cleared') THEN 'strong' ELSE 'weak' END AS evidence_strength,
    substr(sha256(device_id || '|' || CAST(event_id AS STRING)), 1, 16) AS reference FROM typed WHERE evidence_type IS NOT NULL""")
def prd_event_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outages.classify_events(sql(spark, sf_dir, _event_text()))
    reference = outages.redacted_reference(F.col("device_id"), F.col("event_id").cast("string"))
    return rows.select("event_id", "device_id", "evidence_type", "evidence_strength", reference.alias("reference"))


def _event_text() -> str:
    """The rows' SQL with JSON braces doubled, as Spark's parameter syntax asks."""
    out, i = "", 0
    while i < len(_EVENT_ROWS):
        if _EVENT_ROWS.startswith("{events}", i):
            out, i = out + "{events}", i + 8
            continue
        c = _EVENT_ROWS[i]
        out, i = out + (c * 2 if c in "{}" else c), i + 1
    return out


@query("""SELECT device_id, alarm_id, start_us AS outage_start, clear_us AS outage_end, CASE WHEN clear_us IS NULL THEN 'medium' ELSE 'high' END AS confidence
  FROM alarms WHERE start_us IS NOT NULL""")
def win_alarm_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outages.alarm_labels(shape(spark, sf_dir, "alarms"))


@query("""WITH l AS (SELECT device_id, us AS outage_start, evidence_type || '-' || CAST(arrival_seq AS STRING) AS source,
      CASE evidence_strength WHEN 'strong' THEN 'high' WHEN 'weak' THEN 'medium' ELSE 'low' END AS confidence FROM evidence)
  SELECT device_id, outage_start, source, confidence FROM l QUALIFY row_number() OVER (PARTITION BY device_id, floor(outage_start / 43200000000.0E0)
    ORDER BY CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC, outage_start, source) = 1""")
def win_dedupe_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = sql(spark, sf_dir, """
      SELECT device_id, us AS outage_start, evidence_type || '-' || CAST(arrival_seq AS STRING) AS source,
        CASE evidence_strength WHEN 'strong' THEN 'high' WHEN 'weak' THEN 'medium' ELSE 'low' END AS confidence FROM {evidence}""")  # fmt: skip
    return outages.dedupe_labels(labels, tolerance_s=43_200)


_SPANS = f"spans AS (SELECT device_id, (max(us) - min(us)) / {float(DAY_US)} AS span_days, count(*) AS n_strong FROM evidence WHERE evidence_strength = 'strong' GROUP BY 1)"


@query(f"WITH {_SPANS} SELECT * FROM spans")
def agg_evidence_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outages.evidence_spans(shape(spark, sf_dir, "evidence"))


_VERDICTS = f"""verdicts AS (SELECT device_id, bool_or(completeness IN ('ok', 'complete', 'success', 'empty_verified')) AS covered,
    max(newest_us) FILTER (completeness IN ('ok', 'complete', 'success', 'empty_verified')) AS newest_us FROM ledger GROUP BY 1),
  judged AS (SELECT *, coalesce({END_US} - newest_us > {2 * DAY_US}, true) AS stale FROM verdicts)"""


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outages.coverage_verdicts(shape(spark, sf_dir, "ledger"), END_US, min_days=2)


@query(f"WITH {_VERDICTS} SELECT * FROM judged")
def lbl_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir)


_SAMPLES = f"""samples AS (SELECT device_id, unnest(generate_series(CAST({START_US} AS BIGINT), {END_US - 1}, {12 * HOUR_US})) AS anchor_us FROM (SELECT DISTINCT device_id FROM evidence)),
  tagged AS (SELECT *, CASE WHEN anchor_us % {5 * DAY_US} = 0 THEN 'purged' WHEN anchor_us < {START_US + 20 * DAY_US} THEN 'train' ELSE 'test' END AS split FROM samples)"""


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = shape(spark, sf_dir, "evidence").select("device_id").distinct()
    days = F.explode(F.sequence(F.lit(START_US), F.lit(END_US - 1), F.lit(12 * HOUR_US)))
    t = F.col("anchor_us")
    split = F.when(t % (5 * DAY_US) == 0, "purged").when(t < START_US + 20 * DAY_US, "train").otherwise("test")
    return devices.select("device_id", days.alias("anchor_us")).withColumn("split", split)


def _labels_sql(gated: bool) -> str:
    gate = (
        """WHEN v.covered IS NULL OR NOT v.covered THEN 'no_label_source_coverage_for_device' WHEN v.stale THEN 'label_source_history_stale'"""
        if gated
        else "WHEN coalesce(p.span_days, 0) < 7 THEN 'unverified_negative_coverage'"
    )
    return f"""{_WINDOWS}, {_SPANS}, {_VERDICTS}, {_SAMPLES},
  hits AS (SELECT t.*, p.span_days, v.covered, v.stale,
      (SELECT count(*) FROM windows w WHERE w.window_closed) AS n_verified,
      (SELECT min(outage_start) FROM windows w WHERE w.device_id = t.device_id AND NOT w.window_closed) AS open_us,
      EXISTS (SELECT 1 FROM windows w WHERE w.device_id = t.device_id AND w.window_closed AND w.outage_start <= t.anchor_us AND t.anchor_us <= w.outage_end) AS inside,
      EXISTS (SELECT 1 FROM windows w WHERE w.device_id = t.device_id AND w.window_closed AND w.outage_start > t.anchor_us AND w.outage_start <= t.anchor_us + {24 * HOUR_US}) AS ahead
    FROM tagged t LEFT JOIN spans p USING (device_id) LEFT JOIN judged v USING (device_id)),
  labelled AS (SELECT device_id, anchor_us, split, ahead, CASE WHEN n_verified = 0 THEN 'no_verified_outage_source' WHEN split = 'purged' THEN 'split_purge_gap'
      WHEN anchor_us + {24 * HOUR_US} > {END_US} THEN 'future_label_coverage_incomplete' WHEN open_us <= anchor_us THEN 'inside_verified_outage'
      WHEN inside THEN 'inside_verified_outage' WHEN ahead THEN NULL {gate.replace('v.', '').replace('p.', '')}
      WHEN open_us IS NOT NULL THEN 'open_outage_window_unverified' END AS censor_reason FROM hits),
  final AS (SELECT device_id, anchor_us, split, CASE WHEN censor_reason IS NULL THEN CAST(ahead AS INTEGER) END AS y,
      CASE WHEN censor_reason IS NULL THEN 'measured' ELSE 'censored' END AS label_status, censor_reason FROM labelled)"""


@query(f"WITH {_labels_sql(True)} SELECT * FROM final")
def lbl_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = outages.evidence_spans(shape(spark, sf_dir, "evidence"))
    return outages.label_samples(_samples(spark, sf_dir), _windows(spark, sf_dir), spans, END_US, verdicts=_verdicts(spark, sf_dir))


@query(f"WITH {_labels_sql(False)} SELECT * FROM final")
def lbl_samples_ungated(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = outages.evidence_spans(shape(spark, sf_dir, "evidence"))
    return outages.label_samples(_samples(spark, sf_dir), _windows(spark, sf_dir), spans, END_US)


@query(f"""WITH {_labels_sql(True)}, aged AS (SELECT *, anchor_us % 7 AS n_rows, CASE WHEN anchor_us % 11 = 0 THEN NULL ELSE CAST(anchor_us / {HOUR_US} AS BIGINT) % 30 END AS last_age_h FROM final)
  SELECT device_id, anchor_us, CASE WHEN n_rows <= 0 THEN 'no_history' WHEN censor_reason IS NOT NULL THEN censor_reason WHEN NOT coalesce(last_age_h <= 24, false) THEN 'stale_data' END AS ineligible_reason,
    n_rows > 0 AND label_status = 'measured' AND split IN ('train', 'validation', 'test') AND coalesce(last_age_h <= 24, false) AS eligible,
    n_rows > 0 AND split IN ('train', 'validation', 'test') AS anomaly_eligible FROM aged""")
def lbl_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("anchor_us")
    age = F.when(t % 11 == 0, F.lit(None)).otherwise((t / HOUR_US).cast("long") % 30)
    labelled = lbl_samples(spark, sf_dir).withColumns({"n_rows": t % 7, "last_age_h": age})
    return outages.eligibility(labelled).select("device_id", "anchor_us", "ineligible_reason", "eligible", "anomaly_eligible")


@query(f"""WITH {_WINDOWS}, {_SAMPLES} SELECT s.device_id, s.anchor_us, count(*) AS n_ahead, min(w.outage_start) AS first_start FROM samples s
  JOIN windows w ON s.device_id = w.device_id AND w.outage_start > s.anchor_us AND w.outage_start <= s.anchor_us + {24 * HOUR_US} GROUP BY ALL""")
def join_interval_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir)
    met = outages.sweep(_samples(spark, sf_dir), windows, 24 * HOUR_US).where("n_ahead > 0")
    return outages.next_start(met, windows).select("device_id", "anchor_us", "n_ahead", "first_start")


# ---- splits -------------------------------------------------------------------------------------------------------

_GROUPED = "SELECT CAST(user_id % 40 AS STRING) AS grp, event_id, [us ts] + (user_id % 40) * 86400000000 * 20 AS anchor_us FROM {events}"
_CUTS = f"""g AS (SELECT grp, median(anchor_us) AS median_us, count(*) AS n FROM ({_GROUPED.replace('{events}', 'events')}) GROUP BY 1),
  u AS (SELECT *, row_number() OVER w AS k, sum(n) OVER w AS upto, sum(n) OVER () AS total, count(*) OVER () AS groups FROM g WINDOW w AS (ORDER BY median_us, grp)),
  cut AS (SELECT a.k AS c1, b.k AS c2 FROM u a JOIN u b ON a.k < b.k AND b.k < b.groups
    ORDER BY round(abs(a.upto - 0.7E0 * a.total) + abs(b.upto - a.upto - 0.15E0 * a.total) + abs(a.total - b.upto - 0.15E0 * a.total), 6), 1, 2 LIMIT 1),
  split_groups AS (SELECT grp, CAST(median_us AS DOUBLE) AS median_us, n AS rows, CASE WHEN k <= c1 THEN 'train' WHEN k <= c2 THEN 'validation' ELSE 'test' END AS split FROM u, cut)"""


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, _GROUPED)


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _grouped(spark, sf_dir)
    return rows.join(splits.group_splits(rows, "grp").select("grp", "split"), "grp")


@query(f"WITH {_CUTS} SELECT * FROM split_groups")
def spl_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.group_splits(_grouped(spark, sf_dir), "grp")


_ROWS = f"rows_ AS (SELECT r.*, split FROM ({_GROUPED.replace('{events}', 'events')}) r JOIN split_groups USING (grp))"
_BORDERS = """borders AS (SELECT (max(anchor_us) FILTER (split = 'train') + min(anchor_us) FILTER (split = 'validation')) / 2.0E0 AS b1,
    (max(anchor_us) FILTER (split = 'validation') + min(anchor_us) FILTER (split = 'test')) / 2.0E0 AS b2 FROM rows_)"""


def _purge_sql(hours: int) -> str:
    h = hours * HOUR_US
    return f"""purged AS (SELECT grp, event_id, anchor_us, CASE WHEN split = 'train' AND anchor_us > b1 - {h} OR split = 'validation' AND anchor_us < b1 + {h}
      OR split = 'validation' AND anchor_us > b2 - {h} OR split = 'test' AND anchor_us < b2 + {h} THEN 'purged' ELSE split END AS split FROM rows_, borders)"""


@query(f"WITH {_CUTS}, {_ROWS}, {_BORDERS}, {_purge_sql(174)} SELECT * FROM purged")
def spl_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.purge(_split_rows(spark, sf_dir), 174).select("grp", "event_id", "anchor_us", "split")


@query(f"""WITH {_CUTS}, {_ROWS}, {_BORDERS} SELECT grp, event_id, anchor_us, CASE WHEN abs(anchor_us - b1) <= {24 * HOUR_US} OR abs(anchor_us - b2) <= {24 * HOUR_US}
  THEN 'purged' ELSE split END AS split FROM rows_, borders""")
def spl_chrono(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.purge(_split_rows(spark, sf_dir), 24, both_sides=True).select("grp", "event_id", "anchor_us", "split")


@query("""WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS k, count(*) OVER () AS n FROM events)
  SELECT event_id, CASE WHEN k <= round_even(n * 0.7E0, 0) THEN 'train' WHEN k <= round_even(n * 0.85E0, 0) THEN 'validation' ELSE 'test' END AS split FROM r""")
def spl_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, "SELECT event_id, [us ts] AS us FROM {events}")
    return splits.time_splits(rows, by=["us", "event_id"]).select("event_id", "split")


@query(f"WITH {_CUTS}, {_ROWS}, {_BORDERS}, {_purge_sql(192)} SELECT split, count(*) AS rows, count(DISTINCT grp) AS groups, min(anchor_us) AS first_us, max(anchor_us) AS last_us FROM purged GROUP BY 1")
def agg_split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_report(splits.purge(_split_rows(spark, sf_dir), 192), "grp")


@query(f"WITH {_CUTS}, {_ROWS} SELECT grp FROM rows_ GROUP BY 1 HAVING count(DISTINCT CASE WHEN event_id % 500 = 0 THEN 'test' ELSE split END) > 1")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = _split_rows(spark, sf_dir).withColumn("split", F.when(F.col("event_id") % 500 == 0, "test").otherwise(F.col("split")))
    return splits.group_overlap(mixed, "grp")


@query("SELECT CAST(user_id % 40 AS STRING) AS grp, median(epoch_us(ts)) AS median_us FROM events GROUP BY 1")
def win_median_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, "SELECT CAST(user_id % 40 AS STRING) AS grp, [us ts] AS us FROM {events}")
    return rows.groupBy("grp").agg(F.median("us").alias("median_us"))
