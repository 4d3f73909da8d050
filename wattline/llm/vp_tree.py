"""Nearest vectors by vantage-point trees, one tree per shard.

The largest inner product is the smallest distance once every vector gets one more coordinate that brings all to the
length of the longest, and every query a zero there. Vectors are dealt into shards by a hash of their id; each shard is
stored as a tree: its rows in tree order, a node being a stretch of rows whose first is the vantage point, followed by the
nearer and the farther half, with the least and greatest distances of both. Blocks of queries meet every shard; a block
walks down together, and a half is left out for those queries to which the triangle inequality shows it too far away.

`factor` relaxes that: a half is left out when its least possible distance times `factor` exceeds the distance of the
worst of the k nearest so far. At 1 the search is exact; above, it is faster and may miss neighbours.

Scores are inner products of the original vectors, added up in double precision from the first component to the last.
Vectors that are missing, zero or hold a missing or non-finite component, and rows without id, take no part. Vectors meet
those of equal length only. Ties go to the smaller id; a repeated id is found as often as it occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import list_values, sorted_groups
from wattline.llm.hyperplanes import usable
from wattline.session import materialize

K = 20
FACTOR = 1.0
SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 128
#: Slack for the rounding of stored distances, relative to the longest ones, so that a factor of 1 stays exact.
SLACK = 1e-9


def _tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points as a tree, and four bounds of each node: distances of its nearer and its farther half."""
    order, bounds = np.arange(len(points)), np.zeros((len(points), 4))
    todo = [(0, len(points))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= LEAF:
            continue
        rest = order[lo + 1 : hi]
        far = np.sqrt(((points[rest] - points[order[lo]]) ** 2).sum(axis=1))
        by = np.argsort(far, kind="stable")
        order[lo + 1 : hi], far = rest[by], far[by]
        half = (hi - lo - 1) // 2
        bounds[lo] = far[0], far[half - 1], far[half], far[-1]
        middle = lo + 1 + half
        # The farthest point of a half is a good vantage point for it.
        for a, b in ((lo + 1, middle), (middle, hi)):
            order[[a, b - 1]] = order[[b - 1, a]]
            todo.append((a, b))
    return order, bounds


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("vec_id", kind="stable", ignore_index=True)
    rows = np.stack(part["vector"].to_numpy()).astype(np.float64)
    gap = np.sqrt(np.maximum(part["longest"].iloc[0] - (rows**2).sum(axis=1), 0))
    order, bounds = _tree(np.column_stack([rows, gap]))
    out = part.iloc[order][["shard", "dim", "vec_id", "vector"]].reset_index(drop=True)
    return out.assign(place=np.arange(len(out)), gap=gap[order], bounds=list(bounds))


class _Search:
    """The k best rows of one shard for each query of a block."""

    def __init__(self, ids, rows, gaps, bounds, queries, query_ids, k, factor):
        self.ids, self.rows, self.bounds = ids, rows, bounds
        self.points = np.column_stack([rows, gaps])
        self.queries, self.query_ids, self.k, self.factor = queries, query_ids, k, factor
        n = len(queries)
        self.scores, self.found = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        # |q - x|^2 = |q|^2 + longest - 2 q x
        self.base = (queries**2).sum(axis=1) + (self.points[0] ** 2).sum()
        # Bound of the rounding of such a squared distance; near 0 its root would be far less exact.
        self.blur = 4 * (rows.shape[1] + 8) * np.finfo(np.float64).eps * self.base
        self._walk(0, len(ids), np.arange(n))

    def _products(self, who: np.ndarray, lo: int, hi: int) -> np.ndarray:
        total = np.zeros((len(who), hi - lo))
        for a, b in zip(self.queries[who].T, self.rows[lo:hi].T, strict=True):
            total += a[:, None] * b
        return total

    def _take(self, who: np.ndarray, lo: int, hi: int) -> None:
        scores = self._products(who, lo, hi)
        ids = np.broadcast_to(self.ids[lo:hi], scores.shape)
        scores[ids == self.query_ids[who, None]] = -np.inf
        better = (scores >= self.scores[who, -1:]).any(axis=1)
        who, scores, ids = who[better], scores[better], ids[better]
        if len(who):
            scores = np.hstack([self.scores[who], scores])
            ids = np.hstack([self.found[who], ids])
            best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
            self.scores[who] = np.take_along_axis(scores, best, axis=1)
            self.found[who] = np.take_along_axis(ids, best, axis=1)

    def _walk(self, lo: int, hi: int, who: np.ndarray) -> None:
        if hi - lo <= LEAF:
            self._take(who, lo, hi)
            return
        self._take(who, lo, lo + 1)
        square, blur = self.base[who] - 2 * (self.queries[who] @ self.rows[lo]), self.blur[who]
        low, high = np.sqrt(np.maximum(square - blur, 0)), np.sqrt(np.maximum(square + blur, 0))
        near_lo, near_hi, far_lo, far_hi = self.bounds[lo]
        middle = lo + 1 + (hi - lo - 1) // 2
        halves = [(lo + 1, middle, np.maximum(near_lo - high, low - near_hi)), (middle, hi, np.maximum(far_lo - high, low - far_hi))]
        first_near = (halves[0][2] <= halves[1][2]).sum() * 2 >= len(who)
        for a, b, least in halves if first_near else halves[::-1]:
            worst = np.sqrt(np.maximum(self.base[who] - 2 * self.scores[who, -1] + blur, 0))
            stay = who[least * self.factor <= worst * (1 + SLACK) + SLACK * np.sqrt(self.base[who])]
            if len(stay):
                self._walk(a, b, stay)


def _matrix(group: pa.Table, name: str) -> np.ndarray:
    return list_values(group.column(name))[1].reshape(group.num_rows, -1).astype(np.float64)


def _search(k: int, factor: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["dim", "shard", "block"]):
            asks = group.column("place").to_numpy() < 0
            tree, questions = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
            if not tree.num_rows or not questions.num_rows:
                continue
            names = questions.column("vec_id").to_numpy()
            found = _Search(
                tree.column("vec_id").to_numpy(),
                _matrix(tree, "vector"),
                tree.column("gap").to_numpy(),
                _matrix(tree, "bounds"),
                _matrix(questions, "vector"),
                names,
                k,
                factor,
            )
            real = np.isfinite(found.scores)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(names, k)[real.ravel()]), pa.array(found.found[real]), pa.array(found.scores[real])],
                ["query_id", "vec_id", "score"],
            )

    return run


def build(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The stored index: (dim, shard, place, vec_id, vector, gap, bounds) of all usable rows, each shard in tree order."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select("*", F.size("vector").alias("dim"))
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("length", length)
    sizes = rows.groupBy("dim").agg(F.max("length").alias("longest"), F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = rows.join(materialize(sizes, "vector-sizes"), "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")))
    kind = rows.schema["vector"].dataType.simpleString()
    layout = f"shard long, dim int, vec_id long, vector {kind}, place long, gap double, bounds array<double>"
    trees = dealt.select("dim", "shard", "vec_id", "vector", "longest").groupBy("dim", "shard").applyInPandas(_build, layout)
    return materialize(trees, "vantage-trees")


def search(
    trees: DataFrame,
    queries: DataFrame,
    k: int = K,
    factor: float = FACTOR,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of `trees` for each row of `queries`, itself left out."""
    asked = queries.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    asked = asked.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select("*", F.size("vector").alias("dim"))
    asked = materialize(asked, "vector-queries")
    blocks = max(1, -(-asked.count() // query_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    shards = materialize(trees.select("dim", "shard").distinct(), "tree-shards")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    nodes = trees.select("dim", "shard", every, "place", "vec_id", "vector", "gap", "bounds")
    none = F.array().cast("array<double>")
    asks = asked.join(shards, "dim").select(
        "dim", "shard", "block", F.lit(-1).cast("long").alias("place"), "vec_id", "vector", F.lit(0.0).alias("gap"), none.alias("bounds")
    )
    by = ["dim", "shard", "block"]
    met = nodes.unionByName(asks).repartition(*by).sortWithinPartitions(*by, "place")
    found = met.mapInArrow(_search(k, factor), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
