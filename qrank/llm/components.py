"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) edges of longs -> (a, b) with b the least node of a's component, a != b.

    Each round does a large-star step (every larger neighbour of a node moves
    to the node's least neighbour) and a small-star step (so do the smaller
    ones); the edges shrink to stars in a number of rounds that grows with the
    logarithm of the longest path.  Least neighbours come from a partial
    aggregation, and a node with a third of all edges is a skewed join key
    that adaptive execution splits, never a collected group.  Each round is
    written to the shared folder.  No edges: no rows.
    """
    edges = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    before = _digest(edges)
    for _ in range(max_rounds):
        if not before[0]:
            return edges
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.where("b > a").join(least, "a").where("b != m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # every edge now points from the larger to the smaller node
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))))
        edges = materialize(small.distinct(), "edges")
        now = _digest(edges)
        if now == before:
            return edges
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
