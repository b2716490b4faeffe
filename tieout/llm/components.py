"""Connected components of links between numbers, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.durable import materialise
from tieout.llm.common import map_batches

MAX_ROUNDS = 60


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number in the links with the smallest number it reaches through these links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        # Hook the roots, not only the ends, so that chains shorten by halves.
        for end in (i, j):
            np.minimum.at(root, root[end], low)
            np.minimum.at(root, end, low)
        root = root[root]
        if np.array_equal(before, root):
            return nodes, nodes[root]


def _contract(batch: pd.DataFrame) -> pd.DataFrame:
    nodes, roots = local_roots(batch["a"].to_numpy(), batch["b"].to_numpy())
    apart = nodes != roots
    return pd.DataFrame({"a": nodes[apart], "b": roots[apart]})


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every number in `links` (a, b): the smallest number it reaches.

    Links of a batch first shrink to a forest. Then, in turns, every node hands its larger
    neighbours, and its smaller ones, to the smallest of them; the number of links never grows,
    and the number of rounds follows the logarithm of the longest path. Links with a null end
    and links of a number with itself say nothing and are left out.
    """
    typed = links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    forest = map_batches(
        typed.where(F.col("a") != F.col("b")), _contract, "a bigint, b bigint"
    )
    edges, seen = materialise(forest.distinct()), None
    for _ in range(MAX_ROUNDS):
        edges = materialise(_star(_star(edges, large=True), large=False))
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each edge points from the larger number (a) to the smaller (b), before and after."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    low = around.groupBy("a").agg(F.min("b").alias("low"))
    low = low.select("a", F.least("a", "low").alias("low"))
    met = around.join(low, "a")
    if large:
        found = met.where(F.col("b") > F.col("a"))
        found = found.select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        found = met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
    return found.where(F.col("a") != F.col("b")).distinct()
