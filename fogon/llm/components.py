"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogon.llm.store import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node with the smallest node near it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours with the smallest of them. Edges run from the larger to the smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (a, b) that isn't itself the smallest.

    Rows with equal or null ends are ignored. Each round is written to the shared folder; only a row count and a
    checksum reach the driver. Rounds grow with the logarithm of the longest path, not with the number of nodes.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut(links, name)
    mark = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        links = cut(_small_star(cut(_large_star(links), name)), name)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
