"""Running streaming queries to the end of what is there, into Parquet tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; a local session that names none gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quarry-stream-")
    return f"{root}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again: later steps start from there."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of the Parquet files called ``name`` in ``folder``."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_to_end(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Process all available input and return the sink's table."""
    spark = stream.sparkSession
    out = scratch(spark, "sink")
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", out)
    writer.option("checkpointLocation", scratch(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], progress: str | None = None) -> None:
    """Give each micro-batch to ``handle``, which must be safe to repeat for one batch number; goes on from ``progress`` if there is one."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", progress or scratch(stream.sparkSession, "progress"))
    writer.trigger(availableNow=True).start().awaitTermination()


@contextlib.contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, as operators with timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def carry_on(stream: DataFrame, out: str, progress: str, mode: str = "append") -> None:
    """Process what is new since the last run with the same ``progress`` folder, and add to the table at ``out``.

    The sink's own log makes a batch that is run again after a stop replace itself.
    """
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()
