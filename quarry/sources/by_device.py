"""A layout by device: tables bucketed and sorted so that windows and joins by device need no exchange.

The files of a bucket hold whole devices in order of time. The layout is a table of the
catalogue, since only there Spark keeps what it is bucketed by.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def save(rows: DataFrame, table: str, path: str, buckets: int, *, by: str = "device_id", order: Sequence[str] = ("us",)) -> DataFrame:
    """Write ``rows`` to ``path`` as ``table``: one file a bucket, sorted by device and then ``order``; an earlier table is replaced."""
    dealt = rows.repartition(buckets, by)  # the hash that buckets use, so a task writes one bucket
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, by).sortBy(by, *order).saveAsTable(table)
    return rows.sparkSession.table(table)


def load(spark: SparkSession, table: str, devices: Sequence[str] = ()) -> DataFrame:
    """The whole table, or some devices of it: buckets without them are not opened."""
    rows = spark.table(table)
    return rows.where(F.col("device_id").isin(list(devices))) if devices else rows


def readable(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """Rows of Parquet files of two layouts, folders of devices and plain files; broken files are passed over.

    Hidden and temporary files (names that begin with a dot or an underscore) are never
    read. ``source_file`` names where a row is from.
    """
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(*paths)
    return rows.select(*schema.names, F.col("_metadata.file_path").alias("source_file"))


def cached(rows: DataFrame, path: str) -> DataFrame:
    """The rows as JSON lines under ``path``; devices that an earlier run put there are not written again.

    A run's files appear when it ends, so a device is in the cache whole or not at all.
    """
    spark = rows.sparkSession
    read = spark.read.schema(rows.schema).option("recursiveFileLookup", "true")
    try:
        missing = rows.join(read.json(path).select("device_id").distinct(), "device_id", "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        missing = rows
    missing.repartition("device_id").write.option("compression", "gzip").json(f"{path}/run={uuid.uuid4().hex}")
    return read.json(path)


def exchanges(df: DataFrame) -> int:
    """How many times the plan moves rows between tasks."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum("Exchange " in line and "BroadcastExchange" not in line for line in lines)


def devices_of(spark: SparkSession, table: str, batch: int = 100) -> Iterator[list[str]]:
    """Names of devices, ``batch`` at a time in order, for a caller that takes them up one after another; bounded by the registry."""
    held: list[str] = []
    for row in spark.table(table).select("device_id").distinct().orderBy("device_id").toLocalIterator():
        held.append(row.device_id)
        if len(held) == batch:
            yield held
            held = []
    if held:
        yield held
