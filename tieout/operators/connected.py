"""Connected components of a graph given as an edge list, in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.durable import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b); a component is its smallest node.

    Large and small stars in turn: every node hands its larger, then its smaller neighbours over
    to the smallest node it knows, until each component is one star. Each step is an aggregate
    and a join with one row per node; the edges are written between rounds.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    stars = materialise(pairs.where(F.col("a") != F.col("b")).distinct())
    before = None
    while (now := _content(stars)) != before:
        before = now
        stars = materialise(_small_star(_large_star(stars)))
    centre = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(centre, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _content(pairs: DataFrame):
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return pairs.agg(F.count(F.lit(1)), F.sum(hashed)).first()


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours, joined to the smallest of its neighbours and itself."""
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself, joined to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").where(F.col("b") != F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
