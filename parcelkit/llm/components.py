"""Connected components of a link table, by alternating star contraction.

``large star`` hangs every larger neighbour of a node on the node's smallest
neighbour, ``small star`` the smaller ones; both keep components as they are
and the links end as stars around each component's smallest node.  Minima are
partial aggregates, the joins back to the links can be split by adaptive
execution at hot nodes, and each round is written to the checkpoint folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links (a, b) that are not their component's smallest, and that smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = np.minimum(new, new[root])
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    hung = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def connected_components(links: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """node and component (smallest node) of every node with a link to another.

    Null ends and self-links are ignored; repeated links count once; no links
    give an empty result.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct().checkpoint()
    mark = _mark(e)
    while mark[0]:
        e = _small_star(_large_star(e)).checkpoint()
        now = _mark(e)
        if now == mark:
            break
        mark = now
    low = e.groupBy("v").agg(F.count(F.lit(1)).alias("n")).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(low)
