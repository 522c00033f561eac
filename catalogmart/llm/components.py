"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import Scratch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()
    return row["n"], row["h"] or 0


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node and root (the smallest node reachable) of every node in edges (a, b).

    Alternates large and small stars until nothing changes; every round is
    written. A hub's edges meet its minimum in an ordinary join, whose hot keys
    adaptive execution can split; minima aggregate partially.
    """
    edges = scratch.keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("m").alias("a"), "b")
        large = scratch.keep(large.where("a <> b").distinct())
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))  # every node with its smaller neighbours
        small = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(small, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        edges = scratch.keep(moved.union(small.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b").distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return scratch.keep(members.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct())
