"""Readers of staged and exported files: parquet, CSV, JSON lines, ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import vocabulary as V

TELEMETRY = T.StructType(
    [
        T.StructField("device_id", T.StringType()), T.StructField("key", T.StringType()), T.StructField("us", T.LongType()),
        T.StructField("arrival_seq", T.LongType()), T.StructField("value_num", T.DoubleType()), T.StructField("value_text", T.StringType()),
    ]
)
LEDGER = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("run_id", "device_id", "key", "endpoint", "completeness", "error")]
    + [T.StructField(c, T.LongType()) for c in ("requested_start_ms", "requested_end_ms", "rows", "oldest_ts", "newest_ts")]
)


class SchemaError(ValueError):
    """A table lacks columns that a reader needs."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise with the names that it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {missing}")
    return df


def staged(spark: SparkSession, path: str, start_us: int, end_us: int, devices: Sequence[str] = (), schema: T.StructType = TELEMETRY) -> DataFrame:
    """Staged telemetry of [start, end) and, if named, of some devices; an absent path gives an empty table.

    The conditions reach the Parquet scan, and day folders outside the range are not opened.
    """
    try:
        rows = spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001 - only a missing path is answered, all else is raised
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    rows = require_columns(rows, schema.names).where((F.col("us") >= start_us) & (F.col("us") < end_us))
    if "day" in rows.columns:
        day = lambda us: F.to_date(F.timestamp_micros(F.lit(us)))
        rows = rows.where((F.col("day") >= day(start_us)) & (F.col("day") <= day(end_us)))
    return rows.where(F.col("device_id").isin(list(devices))) if devices else rows


def staged_events(spark: SparkSession, root: str, bridged: str = "bridged") -> DataFrame:
    """Events of all day folders and, where there are any, alarms bridged to events in a folder of their own."""
    days = spark.read.option("basePath", root).parquet(f"{root}/day=*").drop("day").withColumn("origin", F.lit("event"))
    try:
        alarms = spark.read.parquet(f"{root}/{bridged}").withColumn("origin", F.lit("alarm"))
    except Exception as e:  # noqa: BLE001 - only a missing path is answered, all else is raised
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return days
    return days.unionByName(alarms)


def json_errors(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines of text files, and those among them that are not JSON."""
    lines = spark.read.text(path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.try_parse_json("value").isNull()).alias("n_errors"))


def jdbc_day_reads(url: str, table: str, days: Sequence[tuple[str, str]], keys: Sequence[str], *, time: str = "time", key: str = "key", fetch: int = 50_000) -> dict:
    """Options and predicates for ``spark.read.jdbc``: a read-only session, one half-open day range per partition."""
    listed = ", ".join("'" + k.replace("'", "''") + "'" for k in keys)
    return {
        "url": url,
        "table": table,
        "predicates": [f"{time} >= '{a}' AND {time} < '{b}' AND {key} IN ({listed})" for a, b in days],
        "properties": {"fetchsize": str(fetch), "queryTimeout": "900", "sessionInitStatement": "SET default_transaction_read_only = on"},
    }


def csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV with header; all text unless a schema is given; a byte-order mark is no part of the first name."""
    rows = spark.read.option("header", True).option("inferSchema", False)
    found = (rows.schema(schema) if schema else rows).csv(path)
    return found.withColumnsRenamed({c: c.lstrip("﻿") for c in found.columns})


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines in permissive mode: a line that cannot be read has its text in _corrupt_record."""
    return spark.read.schema(schema.add("_corrupt_record", T.StringType())).json(path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """A coverage ledger, corrupt lines left out."""
    return json_lines(spark, path, T.StructType(LEDGER.fields)).where("_corrupt_record IS NULL").drop("_corrupt_record")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot CSVs with the file each row is from."""
    return csv(spark, path).select("*", F.col("_metadata.file_name").alias("source_file"))


def fault_output(text: Column) -> Column:
    """A struct of fault_class, fault_score and reasons from an exported ``output`` text."""
    part = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    return F.struct(
        F.upper(part(V.FAULT_CLASS)).alias("fault_class"), part(V.FAULT_SCORE).cast("double").alias("fault_score"), part(V.FAULT_REASONS).alias("reasons"),
    )


def critical(parsed: Column, least: float) -> Column:
    """Critical by class, or by score where there is no class."""
    by_score = parsed["fault_class"].isNull() & (parsed["fault_score"] >= least)
    return F.coalesce((parsed["fault_class"] == "CRITICAL") | by_score, F.lit(False))
