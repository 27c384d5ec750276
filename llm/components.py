"""Connected components over an edge table, for groups of any size.

Alternating large-star and small-star steps: in the first, a node's larger
neighbours move to the smallest node it knows; in the second, its smaller
neighbours and itself do.  The edges turn into stars around each component's
smallest node in few rounds (log^2 n at most).  A step is a minimum per node,
which Spark combines before the shuffle, and an equi-join whose large
partitions adaptive execution splits; no group is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import materialise


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (a, b) with ``a`` the centre: each b moves to the least node of a."""
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, label): each node of the edges (a, b) with its component's smallest node.

    Rows with a null or equal ends are no links.  Each round's edges are written
    to shared storage.
    """
    now = materialise(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = _star(both.filter("b > a"), least).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = _star(large, least).unionByName(least.select("a", F.col("least").alias("b")))
        new = materialise(small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        now = new
        # Done when each node has one centre and no centre has one itself.
        ends = (new.select(F.col("a").alias("node"), F.lit(1).alias("has"), F.lit(0).alias("is"))
                .unionByName(new.select(F.col("b").alias("node"), F.lit(0).alias("has"), F.lit(1).alias("is"))))
        open_ = ends.groupBy("node").agg(F.sum("has").alias("has"), F.sum("is").alias("is")).filter("has > 1 OR has = 1 AND is > 0")
        if open_.isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
