"""Extraction in batches, a job each, with a manifest from which a later run goes on.

A batch is a day and some keys. Its rows are written to a folder of its own and counted in
the same job; then its record is put in place by a rename. A batch that fails is a record
and not the end of the run, readers open only folders whose record says that they are
whole, and a rerun takes up what is failed, over the cap or missing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalars import DAY_US
from quarry.operators.quality import quarantine

MANIFEST = "batch string, day long, part int, status string, error string, n_rows long, n_written long, oldest_us long, newest_us long, attempt int"
#: Statuses that a rerun leaves alone.
DONE = ("ok", "empty")


@dataclass(frozen=True)
class Batch:
    day: int
    part: int
    keys: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"day={self.day}-part={self.part}"


def batches(first_day: int, end_day: int, keys: Sequence[str], per_batch: int, most_days: int | None = None) -> list[Batch]:
    """Days in order, of each the keys in order, ``per_batch`` at a time; at most ``most_days`` days."""
    ordered = sorted(keys)
    groups = [tuple(ordered[k : k + per_batch]) for k in range(0, len(ordered), per_batch)]
    days = range(first_day, end_day if most_days is None else min(end_day, first_day + most_days))
    return [Batch(d, k, g) for d in days for k, g in enumerate(groups)]


class Folder:
    """The run's folder: ``data/<batch>`` with rows, ``manifest/<batch>.json`` with a record each."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self.path = spark, path
        self._jvm = spark._jvm
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str) -> object:
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *(p for p in parts if p))))

    def data(self, batch: str) -> str:
        return f"{self.path}/data/{batch}"

    def has(self, name: str) -> bool:
        return self._files.exists(self._path(name))

    def remove(self, batch: str) -> None:
        self._files.delete(self._path("data", batch), True)

    def put(self, name: str, data: bytes) -> None:
        """A file in place whole: written beside, then renamed."""
        folder, _, leaf = name.rpartition("/")
        draft, final = self._path(folder, f".{leaf}.draft"), self._path(folder, leaf)
        stream = self._files.create(draft, True)
        stream.write(bytearray(data))
        stream.close()
        self._files.delete(final, False)
        if not self._files.rename(draft, final):
            raise OSError(f"cannot put {name}")

    def commit(self, record: dict) -> None:
        self.put(f"manifest/{record['batch']}.json", json.dumps(record).encode())

    def manifest(self) -> DataFrame:
        if not self.has("manifest"):
            return self._spark.createDataFrame([], MANIFEST)
        return self._spark.read.schema(MANIFEST).json(f"{self.path}/manifest")

    def rows(self, schema: T.StructType | str) -> DataFrame:
        """The rows of all batches that are whole. What reaches the driver are names of folders."""
        whole = [r.batch for r in self.manifest().where("status = 'ok'").select("batch").collect()]
        if not whole:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*(self.data(b) for b in sorted(whole)))


def _one(folder: Folder, batch: Batch, read: Callable[[Batch], DataFrame], cap: int | None, attempt: int) -> None:
    record = {"batch": batch.name, "day": batch.day, "part": batch.part, "attempt": attempt, "n_written": 0}
    try:
        seen = Observation()
        good = F.col("reason").isNull()
        rows = read(batch).observe(
            seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(good).alias("n_written"), F.min(F.when(good, F.col("us"))).alias("oldest_us"),
            F.max(F.when(good, F.col("us"))).alias("newest_us"),
        )
        rows.where("reason IS NULL").drop("reason").write.mode("overwrite").parquet(folder.data(batch.name))
        record |= seen.get
        record["status"] = "ok" if record["n_rows"] else "empty"
        if cap is not None and record["n_rows"] >= cap:
            folder.remove(batch.name)
            record |= {"status": "over_cap", "n_written": 0, "oldest_us": None, "newest_us": None, "error": f"{record['n_rows']} rows reach the cap of {cap}"}
    except Exception as e:  # noqa: BLE001 - whatever ends a batch is its record
        folder.remove(batch.name)
        record |= {"status": "failed", "n_written": 0, "error": f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]}
    folder.commit(record)


def run(spark: SparkSession, work: Iterable[Batch], read: Callable[[Batch], DataFrame], path: str, *, cap: int | None = 750_000, at_once: int = 8) -> DataFrame:
    """Extract ``work`` to ``path`` and return the manifest, a record a batch.

    ``read`` gives a batch's rows with ``reason`` (null for good ones) and ``us``; it must ask the
    source for the batch alone. A batch of ``cap`` rows or more is left out whole. ``at_once``
    jobs are in flight. Batches that an earlier run finished are not read again.
    """
    folder = Folder(spark, path)
    before = {r.batch: r for r in folder.manifest().select("batch", "status", "attempt").collect()}
    left = [b for b in work if b.name not in before or before[b.name].status not in DONE]
    with ThreadPoolExecutor(at_once) as pool:
        jobs = [pool.submit(_one, folder, b, read, cap, before[b.name].attempt + 1 if b.name in before else 1) for b in left]
        for job in jobs:
            job.result()
    return folder.manifest()


def telemetry_reader(raw: DataFrame, now_us: int) -> Callable[[Batch], DataFrame]:
    """Batches of raw readings that have a column ``day`` the source is laid out by, judged by ``quarantine``.

    A reading belongs to its own day: judged rows of another time, or without one, have no batch.
    """

    def read(batch: Batch) -> DataFrame:
        own = raw.where((F.col("day") == batch.day) & F.col("key").isin(list(batch.keys))).drop("day")
        judged = quarantine(own, now_us)
        return judged.where((F.col("us") >= batch.day * DAY_US) & (F.col("us") < (batch.day + 1) * DAY_US))

    return read


def events_reader(events: DataFrame, kind: str = "evidence_type") -> Callable[[Batch], DataFrame]:
    """Batches of events of the kinds of interest (a batch's keys), laid out by ``day``."""

    def read(batch: Batch) -> DataFrame:
        own = events.where((F.col("day") == batch.day) & F.col(kind).isin(list(batch.keys))).drop("day")
        return own.withColumn("reason", F.lit(None).cast("string"))

    return read
