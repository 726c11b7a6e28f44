"""Lineage cuts: tables written to the folder that every node of the cluster shares."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_default: str | None = None
#: Tables written since each ``passing`` around this call was entered, the innermost last. Every thread has its own.
_written: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("written", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a local session (a test) may name none; a temporary folder is made for it.
    On a cluster other nodes would not see such a folder, so that raises.
    """
    global _local_default
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    if _local_default is None:
        _local_default = tempfile.mkdtemp(prefix="quarry-checkpoint-")
    return _local_default


def settle(df: DataFrame, label: str, *, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a reader of it.

    Later stages start from these files: a lost executor costs a reread, not the
    work upstream, and the row count and size are known to the planner. With ``keep``
    the table outlives the ``passing`` around it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    owners = _written.get()[: -1 if keep else None]
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside are deleted at the end, except those to keep: what is read later must be one of these."""
    own: list[str] = []
    token = _written.set((*_written.get(), own))
    try:
        yield
    finally:
        _written.reset(token)
        for path in own:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def extended(rows: DataFrame, columns: list[str], added: str) -> StructType:
    """The schema of ``columns`` of ``rows`` and of the columns that the DDL ``added`` states."""
    return StructType([*(rows.schema[c] for c in columns), *StructType.fromDDL(added).fields])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
