"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegrid.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("root").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node.

    Alternating stars: the number of rounds grows with the logarithm of the longest path. Each
    round is stored, so that a lost executor costs one round at most.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
