"""Sharding by jump consistent hashing, in DataFrame expressions only.

The published jump hash walks a 64-bit linear congruential generator; with n
shards a key ends at the last jump below n, so going from n to n + 1 shards moves
1/(n + 1) of the keys, all of them into the new shard. No ring table exists.

Spark's ANSI mode rejects overflowing BIGINT products, so the generator's state is
kept as two 32-bit halves and multiplied in pieces that stay below 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the published algorithm.
LCG_MULTIPLIER = 2862933555777941757
_M_HI, _M_LO = LCG_MULTIPLIER >> 32, LCG_MULTIPLIER & 0xFFFFFFFF
_LOW32 = 0xFFFFFFFF

#: A walk below 2^31 shards takes 22 jumps on average; over 128 has probability below 1e-50.
MAX_JUMPS = 128


def _low32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_LOW32))


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) of state * LCG_MULTIPLIER + 1 modulo 2^64."""
    m_lo, m_hi = F.lit(_M_LO), F.lit(_M_HI)
    low16 = lambda c: c.bitwiseAND(F.lit(0xFFFF))
    first = low16(lo) * m_lo + F.lit(1)
    second = F.shiftright(lo, 16) * m_lo
    total = first + F.shiftleft(low16(second), 16)
    carry = F.shiftright(total, 32) + F.shiftright(second, 16)
    cross = _low32(low16(hi) * m_lo) + F.shiftleft(low16(F.shiftright(hi, 16) * m_lo), 16)
    return _low32(carry + _low32(lo * m_hi) + cross), _low32(total)


def jump_buckets(key: Column, *shard_counts: int) -> Column:
    """A struct with one field ``b<n>`` per shard count: the key's bucket among n.

    All counts share one walk. A null key walks as key 0.
    """
    most = max(shard_counts)
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")

    def state(j: Column, hi: Column, lo: Column, buckets: list[Column]) -> Column:
        return F.struct(
            j.alias("j"), hi.alias("hi"), lo.alias("lo"),
            *(b.alias(f"b{n}") for n, b in zip(shard_counts, buckets)),
        )

    def jump(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        reach = F.lit(2147483648.0) / (F.shiftright(hi, 1) + F.lit(1)).cast("double")
        landed = F.floor((s["j"] + F.lit(1)).cast("double") * reach)
        buckets = [F.when(s["j"] < n, s["j"]).otherwise(s[f"b{n}"]) for n in shard_counts]
        return F.when(s["j"] >= most, s).otherwise(state(landed, hi, lo, buckets))

    start = state(zero, _low32(F.shiftrightunsigned(key, 32)), _low32(key), [zero] * len(shard_counts))
    steps = F.sequence(F.lit(1), F.lit(min(most, MAX_JUMPS)))
    return F.aggregate(steps, start, jump)


def shard(
    docs: DataFrame,
    n_shards: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    blocks: int = 256,
) -> DataFrame:
    """Assign every row a shard by its key, and a gapless slot inside the shard.

    Returns key, size (UTF-8 bytes of the text plus 8), text_crc32, law (``key``),
    shard, slot, grown_shard (the shard if there were one more) and block.

    A shard holds 1/n of the keys and may be far larger than a task, so a slot is
    numbered inside one of ``blocks`` slices of the shard (cut by further bits of the
    key's generator) and then moved up by the row counts of the slices before it. The
    counts, n_shards * blocks rows at most, are made from the key column alone.

    Null text: size 8, crc32 null. Empty text: size 8, crc32 0. Null keys: all
    together as key 0. Repeated rows each get a slot of their own; equal keys share a
    shard. An empty table gives an empty result. Other input columns are not read.
    """
    wanted = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def placed(df: DataFrame) -> DataFrame:
        walk = df.withColumn("_w", jump_buckets(F.col("doc_id"), n_shards, n_shards + 1))
        hi, _ = _next_state(
            _low32(F.shiftrightunsigned(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), 32)),
            _low32(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))),
        )
        return walk.select(
            *df.columns,
            F.col(f"_w.b{n_shards}").cast("int").alias("shard"),
            F.col(f"_w.b{n_shards + 1}").cast("int").alias("grown_shard"),
            (hi % F.lit(blocks)).cast("int").alias("block"),
        )

    counts = placed(wanted.select("doc_id")).groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))

    rows = placed(
        wanted.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        )
    )
    within = Window.partitionBy("shard", "block").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(within))
    # n_shards * blocks rows of 16 bytes: the bound is fixed by parameters, not by the data
    return ranked.join(F.broadcast(starts), ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard", "block",
    )
