"""The synthetic tables, and the telemetry shapes that stand on them.

A shape is one SQL text for Spark and for the oracle engine; ``[us x]`` stands for the
microseconds since 1970 of a timestamp without zone, and ``{name}`` for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_SPARK_US = r"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', \1)"
_ORACLE_US = r"epoch_us(\1)"

SHAPES = {
    "telemetry": """
        SELECT CAST(user_id AS STRING) AS device_id, event_type AS key, [us ts] AS us, event_id AS arrival_seq,
          value AS value_num, props AS value_text
        FROM {events}""",
    # every kind of bad record, at fixed places, and later duplicates with other values
    "raw_telemetry": """
        SELECT CAST(user_id AS STRING) AS device_id, event_type AS key, event_id AS arrival_seq,
          CASE WHEN event_id % 97 = 0 THEN 'not-a-timestamp' WHEN event_id % 89 = 0 THEN NULL
            WHEN event_id % 83 = 0 THEN '1970-01-01 00:00:00' WHEN event_id % 79 = 0 THEN '2031-01-01 00:00:00'
            ELSE CAST(ts AS STRING) END AS time,
          CASE WHEN event_id % 7 = 3 THEN NULL ELSE value END AS value_num,
          CASE WHEN event_id % 7 = 3 AND event_id % 3 > 0 THEN NULL ELSE props END AS value_text
        FROM {events}
        UNION ALL
        SELECT CAST(user_id AS STRING), event_type, event_id + 1000000000, CAST(ts AS STRING), value + 1, props
        FROM {events} WHERE event_id % 71 = 0""",
    "evidence": """
        SELECT CAST(user_id AS STRING) AS device_id, [us ts] AS us, event_id AS arrival_seq,
          CASE event_type WHEN 'error' THEN 'lc_disconnect' WHEN 'signup' THEN 'lc_connect'
            WHEN 'view' THEN 'current_attr_snapshot' WHEN 'click' THEN 'alarm_channel' ELSE 'unknown' END AS evidence_type,
          CASE WHEN event_type IN ('error', 'signup') THEN 'strong' WHEN event_type IN ('view', 'click') THEN 'weak'
            ELSE 'none' END AS evidence_strength
        FROM {events}""",
    "alarms": """
        SELECT CAST(o_custkey AS STRING) AS device_id, o_orderkey AS alarm_id,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'BOI- CAMERA TAMPER CH 2'
            WHEN o_orderpriority = '2-HIGH' THEN 'CAMERA DISCONNECT CH 9'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'DVR/NVR OFF' ELSE 'POWER FAIL' END AS alarm_type,
          o_orderpriority AS severity, o_orderstatus AS status, o_totalprice AS weight,
          CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE [us CAST(o_orderdate AS TIMESTAMP_NTZ)] END AS start_us,
          CASE WHEN o_orderstatus = 'F' THEN [us CAST(o_orderdate AS TIMESTAMP_NTZ)] + (o_orderkey % 5) * 86400000000 END AS clear_us,
          [us CAST(o_orderdate AS TIMESTAMP_NTZ)] + 3600000000 AS ack_us
        FROM {orders}""",
    "devices": """
        SELECT CAST(c_custkey AS STRING) AS device_id,
          CASE WHEN c_custkey % 17 = 0 THEN 'test-' || c_name WHEN c_custkey % 23 = 0 THEN 'demo ' || c_name ELSE c_name END AS name,
          CASE WHEN c_custkey % 29 = 0 THEN 'simulator' WHEN c_custkey % 34 = 0 THEN 'recorder' ELSE 'gateway' END AS type,
          CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS customer_id,
          r_name AS bank, n_name AS zone, CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS branch,
          c_acctbal AS balance, c_custkey % 13 AS key_count
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # a record per request; a later sequence number supersedes the same request; every tenth device has none that succeeded
    "ledger": """
        SELECT CAST(user_id AS STRING) AS device_id, event_type AS key, event_id AS seq, event_id % 3 AS request,
          CASE WHEN event_id % 11 = 0 OR user_id % 10 = 7 THEN 'failed' WHEN event_id % 13 = 0 THEN 'partial'
            WHEN event_id % 17 = 0 THEN 'empty_verified' ELSE 'complete' END AS completeness,
          CASE WHEN event_id % 11 = 0 OR user_id % 10 = 7 THEN 'TimeoutError after 30 s' WHEN event_id % 13 = 0 THEN 'Stalled cursor' END AS error,
          CAST(event_id % 100 AS BIGINT) AS n_rows, [us ts] AS newest_us
        FROM {events}""",
    # several lines a device: an hourly risk score and whether an outage follows
    "scored": """
        SELECT CAST(user_id AS STRING) AS device_id, [us ts] AS anchor_us, event_id AS arrival_seq,
          CAST(floor(value * 10) AS BIGINT) % 100 / 100.0E0 AS probability,
          CASE WHEN event_type = 'error' OR event_id % 19 = 0 THEN 1 ELSE 0 END AS y
        FROM {events}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a text over the tables and shapes that it names in braces."""
    names = set(re.findall(r"{(\w+)}", text))
    frames = {n: shape(spark, sf_dir, n) if n in SHAPES else table(spark, sf_dir, n) for n in names}
    return spark.sql(re.sub(r"\[us (.+?)\](?= |,|\)|$)", _SPARK_US, text), **frames)


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sql(spark, sf_dir, SHAPES[name])


def oracle(text: str) -> str:
    """An oracle statement: shapes that it names become leading common tables."""
    used = [n for n in SHAPES if re.search(rf"\b{n}\b", text)]
    plain = lambda t: re.sub(r"{(\w+)}", r"\1", re.sub(r"\[us (.+?)\](?= |,|\)|$)", _ORACLE_US, t)).replace("TIMESTAMP_NTZ", "TIMESTAMP")
    tables = ", ".join(f"{n} AS ({plain(SHAPES[n])})" for n in used)
    if not tables:
        return plain(text)
    body = plain(text).strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {tables}, {body[15:]}"
    return f"WITH {tables}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {tables} {body}"
