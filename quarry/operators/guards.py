"""Guards on statements and runs, and the statuses that a run can end with."""

from __future__ import annotations

import re
from enum import IntEnum

from pyspark.sql import DataFrame, SparkSession

#: How a read-only statement may begin, and words that it may not contain.
READ_WORDS = ("select", "with", "show", "explain", "values", "table")
WRITE_WORDS = [
    "insert", "update", "delete", "drop", "create", "alter", "truncate", "grant", "revoke", "vacuum", "reindex", "copy", "call", "do",
    "refresh", "cluster", "comment", "set", "reset", "lock", "listen", "notify", "prepare", "execute", "discard",
]


class WriteStatementError(ValueError):
    """A statement could change something."""


class Status(IntEnum):
    """How a run ended."""

    OK = 0
    NO_ROWS = 1
    CONFIGURATION = 2
    NO_VERIFIED_EVIDENCE = 3
    NO_USABLE_DATA = 4
    LEAKAGE = 5


def read_only(statement: str) -> str:
    """The statement without closing semicolons, or an error if it is empty or could write."""
    plain = re.sub(r"[;\s]+$", "", statement.strip())
    words = re.findall(r"[a-z]+", plain.lower())
    if not words or words[0] not in READ_WORDS:
        raise WriteStatementError(f"not a read: {plain[:60]!r}")
    if ";" in plain or (found := sorted(set(words) & set(WRITE_WORDS))):
        raise WriteStatementError(f"not only a read ({'several statements' if ';' in plain else found}): {plain[:60]!r}")
    return plain


def read_sql(spark: SparkSession, statement: str) -> DataFrame:
    return spark.sql(read_only(statement))


def dataset_status(windows: DataFrame, samples: DataFrame) -> Status:
    """The status of a labelled dataset: usable only with rows and with a verified outage."""
    if samples.isEmpty():
        return Status.NO_USABLE_DATA
    return Status.OK if not windows.where("window_closed").isEmpty() else Status.NO_VERIFIED_EVIDENCE
