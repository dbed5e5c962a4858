"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.sources.shared import discard, materialize


def _star_step(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges point from larger to smaller nodes."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    large = materialize(large)
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    rest = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = materialize(rest.union(lowest.select("a", F.col("m").alias("b"))).distinct())
    discard(large)
    return out


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads straight to a root, and every node has one edge."""
    total, nodes = edges.agg(F.count("*"), F.countDistinct("a")).first()
    if total != nodes:
        return False
    return not edges.select("a", F.col("b").alias("root")).join(edges.select(F.col("a").alias("root")), "root", "left_semi").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``); the root is the smallest node reached.

    Alternating stars: the number of rounds grows with the logarithm of the longest
    chain, adjacency lists are never gathered, and each round is written to the shared
    folder. No edges give no rows.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges)
    while not _settled(edges):
        before, edges = edges, _star_step(edges)
        discard(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
