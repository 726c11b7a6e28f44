"""Comparison of a Spark result with a DuckDB statement over the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    if hasattr(value, "quantize"):
        return float(value)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def assert_equal(df: DataFrame, sql: str, folder: str) -> int:
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    expected = con.sql(sql)
    assert sorted(expected.columns) == sorted(df.columns)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert found == rows_of(expected.columns, expected.fetchall())
    return len(found)
