"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour instead."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for all nodes of the edges ``a``, ``b``.

    Each round shortens paths to the smallest node by more than half; it ends when a round changes
    nothing. Edges of a node to itself, repeated and null ones do not matter: a node is in the
    result only if it has an edge to another. Rounds are checkpointed.
    """
    known = materialise(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = known.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen is not None and tuple(mark) == tuple(seen):
            break
        seen = mark
        known = materialise(_small_star(_large_star(known)))
    roots = known.select(F.col("b").alias("node")).distinct()
    return known.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
