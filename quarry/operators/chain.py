"""Runs of several steps with a record a step, from which a later run goes on.

A step's rows are written below the run's folder, then its record is put in place. A step
that fails is a record: steps that need it are skipped, the others are done. A rerun
takes up what is not done and rereads the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from enum import IntEnum

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.extract import Folder

MANIFEST = "step string, place int, status string, error string, n_rows long, attempt int"


class Outcome(IntEnum):
    """How a run ended: all done, ended at a step that it cannot do without, or done but for some steps."""

    OK = 0
    FAILED = 1
    INCOMPLETE = 5


@dataclass(frozen=True)
class Step:
    """``work`` takes the rows of the steps done so far, by name. A run ends where a step fails that is not ``tolerated``."""

    name: str
    work: Callable[[dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    tolerated: bool = True


def _record(spark: SparkSession, folder: Folder, step: Step, place: int, done: dict[str, DataFrame], attempt: int) -> dict:
    record = {"step": step.name, "place": place, "attempt": attempt}
    lacking = [n for n in step.needs if n not in done]
    if lacking:
        return record | {"status": "skipped", "error": f"needs {', '.join(lacking)}"}
    try:
        rows = step.work(done)
        rows.write.mode("overwrite").parquet(folder.data(step.name))
        done[step.name] = spark.read.schema(rows.schema).parquet(folder.data(step.name))
        return record | {"status": "ok", "n_rows": done[step.name].count()}
    except Exception as e:  # noqa: BLE001 - whatever ends a step is its record
        done.pop(step.name, None)
        return record | {"status": "failed", "error": f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]}


def run(spark: SparkSession, steps: Sequence[Step], path: str) -> tuple[Outcome, dict[str, DataFrame], DataFrame]:
    """The outcome, the rows of each step that is done, and the manifest.

    Steps run in order. Those that an earlier run in the same folder did are reread.
    """
    folder = Folder(spark, path)
    before = {r.step: r for r in spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()} if folder.has("manifest") else {}
    done, missed = {}, False
    for place, step in enumerate(steps):
        known = before.get(step.name)
        if known and known.status == "ok":
            done[step.name] = spark.read.parquet(folder.data(step.name))
            continue
        record = _record(spark, folder, step, place, done, (known.attempt if known else 0) + 1)
        folder.put(f"manifest/{step.name}.json", json.dumps(record).encode())
        if record["status"] != "ok":
            missed = True
            if not step.tolerated:
                return Outcome.FAILED, done, spark.read.schema(MANIFEST).json(f"{path}/manifest")
    outcome = Outcome.INCOMPLETE if missed else Outcome.OK
    return outcome, done, spark.read.schema(MANIFEST).json(f"{path}/manifest")
