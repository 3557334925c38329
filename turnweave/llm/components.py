"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _large(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of these."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) for every node of the links ``a, b``; order and repeats don't matter.

    The number of rounds is logarithmic in the diameter. Each round is written to the shared folder.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges = materialize(edges, "edges")
    while True:
        # Done when all edges are stars: no node has two parents or is a parent and a child.
        several = edges.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").select("b")
        chained = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("b")
        if several.union(chained).isEmpty():
            break
        before, edges = edges, materialize(_small(_large(edges)), "edges")
        discard(before)
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
