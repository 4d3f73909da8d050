"""Connected components of a graph held as a table of edges.

Each round links every node's larger neighbours to the smallest node it knows (a large star) and then its smaller
neighbours likewise (a small star). Edges only ever get fewer or point lower, trees flatten in a logarithmic number of
rounds, and in the end every node points at the smallest node of its component. Minima are combined before the shuffle
and the join of a node's edges with its minimum can be split, so a node with very many edges is not one task's work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.session import materialize


def _pointed(edges: DataFrame) -> DataFrame:
    """Distinct edges (u, v), u > v."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(lowest, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.withColumnRenamed("m", "v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); root is the smallest node of the component, loops do not count."""
    edges = materialize(_pointed(edges), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_small_star(materialize(_large_star(edges), "large-star")), "small-star")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place each of n places reaches over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
