"""A bit filter of fixed size, to leave rows behind before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^18 words of 64 bits: some MB as a broadcast table, whatever the data. A million wanted values fill
#: 6 % of its bits, ten million 45 %, a hundred million all: then it saves nothing, and loses nothing.
WORDS = 1 << 18


def _place(c: Column) -> tuple[Column, Column]:
    """The word of a value, and its bit in that word."""
    h = F.xxhash64(c)
    bit = F.shiftrightunsigned(h, 56).bitwiseAND(F.lit(63)).cast("int")
    return F.pmod(h, F.lit(WORDS)), F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _all(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns]


def _marked(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    word, bit = _place(F.col(f"`{wanted.columns[0]}`"))
    # the masks of a word are merged before they are shuffled, so there are WORDS rows at most
    masks = wanted.select(word.alias("__bit_word"), bit.alias("__bit_own")).groupBy("__bit_word").agg(F.bit_or("__bit_own").alias("__bit_mask"))
    word, bit = _place(F.col(f"`{column}`"))
    found = rows.join(F.broadcast(masks), word == F.col("__bit_word"), "left")
    return found.withColumn("__bit_hit", F.coalesce(F.col("__bit_mask").bitwiseAND(bit) != 0, F.lit(False)))


def maybe_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``column`` may be among the values of ``wanted`` (one column).

    No row that is among them is lost; others pass by chance, all of them once the
    filter is full. So a join must follow. Nulls pass if a null is wanted.
    """
    return _marked(rows, column, wanted).where("__bit_hit").select(_all(rows))


def surely_not_in(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The other rows: none of them is among the values of ``wanted``."""
    return _marked(rows, column, wanted).where("NOT __bit_hit").select(_all(rows))
