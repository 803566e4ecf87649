"""Connected components of a graph whose edges are a DataFrame.

Alternating large-star and small-star rounds: each round is one grouped minimum and
one join on each node's own edges, so a node with many edges is only a skewed join,
which adaptive execution splits.  Rounds grow with the logarithm of the longest
path.  Every round is written to the shared scratch folder, so lost executors cost
a rerun of their tasks only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.sources.scratch import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) for every id in the columns ``a, b`` of ``edges``."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, mark = _stored(pairs)
    while True:
        pairs, now = _stored(_small_star(_large_star(pairs)))
        if now == mark:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        mark = now


def _stored(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    kept = materialize(pairs, "components")
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return kept, tuple(kept.agg(F.count("*"), digest).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's smallest neighbour."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all get the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same inside one task: smallest reachable index of each of ``n`` nodes."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
