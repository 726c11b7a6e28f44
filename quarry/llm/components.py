"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b): root is its component's smallest.

    A large star hangs each node's greater neighbours under the smallest of its
    neighbourhood, a small star its lesser ones; the edges become one star per
    component in a number of rounds that grows with the logarithm of its diameter.
    Minima are merged before they are shuffled, and the joins are ordinary ones on
    the node, which adaptive execution splits where a star is large. Each round is
    written to the shared folder. Loops and repeated edges are allowed; an empty table
    gives an empty result.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = settle(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        hung = settle(hung, "large-star")
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        small = hung.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        before, state = state, _state(edges)
        if before == state:
            break
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
