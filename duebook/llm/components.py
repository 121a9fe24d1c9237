"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b; longs) with the smallest node reachable.

    Nodes without an edge do not appear. Rounds go on until the edge set stands still; each writes
    its edges, so a lost executor repeats one round at most. Only a checksum reaches the driver.
    """
    current = stage(edges.where("a <> b").select("a", "b").distinct(), name)
    seen = None
    while True:
        sums = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") / F.lit(2.0**40)), F.bit_xor(F.xxhash64("a", "b"))
        ).first()
        state = (sums[0], sums[2])
        if state == seen or sums[0] == 0:
            break
        seen = state
        current = stage(_small_star(_large_star(current)).where("a <> b").distinct(), name)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
