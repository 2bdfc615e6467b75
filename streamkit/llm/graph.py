"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamkit.llm.common import stage_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not itself a root: the smallest
    node that it reaches.  ``edges`` has longs (a, b).

    Alternates large-star and small-star until the edges stay the same: a
    node's smallest neighbour comes from an aggregation, and is joined back to
    its edges, so the neighbours of a hub are never gathered.  Rounds grow
    with the logarithm of the longest path."""
    now = stage_table(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage_table(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
