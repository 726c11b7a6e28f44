"""What leaves the engine: safe cells, training lines, typed JSON values, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalars import is_missing, number, safe_cell


def safe_rows(rows: DataFrame) -> DataFrame:
    """All cells as text that a spreadsheet takes for text; nested values as JSON."""
    out = []
    for name, kind in rows.dtypes:
        c = F.col(f"`{name}`")
        text = F.to_json(c) if kind.startswith(("struct", "array", "map")) else c.cast("string")
        out.append(safe_cell(text).alias(name))
    return rows.select(out)


def feature_line(columns: Sequence[str]) -> Column:
    """``name 0.123; name 4.000`` of the values that are not null."""
    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c} "), F.format_string("%.3f", F.col(c).cast("double")))) for c in columns]
    return F.array_join(F.array_compact(F.array(*parts)), "; ")


def training_line(columns: Sequence[str], output: Column) -> Column:
    """A JSON line of the filled cells as ``input`` and of ``output``."""
    cells = [F.when(~is_missing(F.col(c)), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns]
    return F.to_json(F.struct(F.array_join(F.array_compact(F.array(*cells)), " ").alias("input"), output.alias("output")))


def json_value(c: Column) -> Column:
    """Text as JSON of the type it reads as: nothing for missing words, numbers (4 decimals), booleans, else text."""
    n = F.round(number(c), 4)
    whole = (n == F.floor(n)) & (F.abs(n) < 1e15)
    return (
        F.when(is_missing(c), F.lit(None))
        .when(n.isNotNull() & whole, n.cast("long").cast("string"))
        .when(n.isNotNull(), n.cast("string"))
        .when(F.lower(F.trim(c)).isin("true", "false"), F.lower(F.trim(c)))
        .otherwise(F.concat(F.lit('"'), F.regexp_replace(c, '(["\\\\])', "\\\\$1"), F.lit('"')))
    )


def drop_empty_columns(rows: DataFrame, *, most_chars: int = 32_000) -> DataFrame:
    """Without columns that have no value in any row; texts cut to a spreadsheet's limit."""
    counts = rows.agg(*(F.count(F.when(~is_missing(F.col(f"`{c}`")), 1)).alias(c) for c in rows.columns)).first()
    kept = [c for c in rows.columns if counts[c]]
    text = {f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"}
    return rows.select(*(F.substring(f"`{c}`", 1, most_chars).alias(c) if c in text else F.col(f"`{c}`") for c in kept))


def quality_report(title: str, metrics: dict[str, object]) -> str:
    """A Markdown report of a few figures."""
    return "\n".join([f"# {title}", "", "| figure | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in metrics.items()), ""])


def write_parquet(rows: DataFrame, path: str, *, by: Sequence[str] = ()) -> None:
    """Parquet files, in a folder per value of ``by``."""
    rows.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """A JSON object per line, null fields included."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv_bom(rows: DataFrame, path: str) -> None:
    """CSV files of safe cells with a header, each beginning with a byte-order mark, as spreadsheets want it."""
    safe = safe_rows(rows)
    marked = safe.withColumnRenamed(safe.columns[0], "\ufeff" + safe.columns[0])
    marked.write.mode("overwrite").option("header", True).csv(path)


def write_labels(labels: DataFrame, path: str) -> None:
    """The same labels as CSV and as JSON lines, below ``path``."""
    labels.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    write_json_lines(labels, f"{path}/jsonl")
