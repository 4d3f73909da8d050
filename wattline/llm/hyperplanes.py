"""Near-duplicate vectors by random-hyperplane signs, exact cosine checks and connected components.

In each table a vector's code holds the sides of BITS random hyperplanes it lies on. Vectors of one label that agree in a
code meet in a bucket and their cosines are computed in double precision, in blocks of at most BLOCK by BLOCK rows, so
that a bucket with a third of all rows is spread over many tasks. A pair that meets in several tables counts in the first
one only. A block gives each vector's number of links and a spanning forest of them; pairs never leave it.

Equal vectors of a label are one class with a number of copies. At a cosine of exactly 0.98 a pair meets in no table with a
probability of about one in a million, and less above. Vectors that are missing, zero or hold a missing or non-finite
component, and rows without label or id, link with nothing and are kept. Vectors of different lengths are not compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import list_values, sorted_groups
from wattline.llm.components import components, spanning
from wattline.session import materialize

THRESHOLD = 0.98
BITS = 16
TABLES = 32
BLOCK = 1024
SEED = 42


def usable(vector: Column) -> Column:
    """Whether a vector is there, has a non-zero component and none that is missing or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _codes(bits: int, tables: int, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            offsets, values = list_values(batch.column("vector"))
            codes = np.zeros((batch.num_rows, tables), np.int64)
            lengths = np.diff(offsets)
            for dim in np.unique(lengths).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
                mine = np.flatnonzero(lengths == dim)
                rows = values[offsets[mine][:, None] + np.arange(dim)].astype(np.float64)
                sides = (rows @ planes[dim] > 0).reshape(len(mine), tables, bits)
                codes[mine] = sides @ (1 << np.arange(bits))
            flat = pa.array(codes.ravel(), pa.int64())
            ends = pa.array(np.arange(0, codes.size + 1, tables), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rep", "copies", "vector")), pa.ListArray.from_arrays(ends, flat)],
                ["rep", "copies", "vector", "codes"],
            )

    return run


def _links(threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket", "at", "left", "right"]):
            n = group.num_rows
            if n < 2:
                continue
            column = lambda name, group=group: group.column(name).to_numpy()
            _, values = list_values(group.column("vector"))
            rows = values.reshape(n, -1).astype(np.float64)
            rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            at, left, right = (int(group.column(c)[0].as_py()) for c in ("at", "left", "right"))
            block, rep, copies = column("block"), column("rep"), column("copies")
            codes = list_values(group.column("codes"))[1].reshape(n, -1)
            a = np.flatnonzero(block == left)
            b = np.flatnonzero(block == right)
            i, j = np.nonzero(rows[a] @ rows[b].T >= threshold)
            if left == right:
                i, j = i[i < j], j[i < j]
            i, j = a[i], b[j]
            new = np.ones(len(i), bool)
            for t in range(at):
                new &= codes[i, t] != codes[j, t]
            i, j = i[new], j[new]
            if not len(i):
                continue
            links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
            linked = np.flatnonzero(links)
            root = rep[spanning(i, j, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[linked]), pa.array(links[linked].astype(np.int64)), pa.array(root[linked])],
                ["rep", "links", "root"],
            )

    return run


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    bits: int = BITS,
    tables: int = TABLES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; a row without id has no component."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    same = [F.when(whole, F.xxhash64(F.lit(k), "label", "vector")).alias(f"same{k}") for k in (1, 2)]
    known = rows.select("vec_id", "label", "vector", *same)
    narrow = materialize(known.select("vec_id", "same1", "same2"), "vector-rows")
    classes = known.where("same1 is not null").groupBy("same1", "same2").agg(
        F.min("vec_id").alias("rep"),
        F.count("*").alias("copies"),
        F.any_value("vector").alias("vector"),
        F.any_value("label").alias("label"),
    )
    classes = materialize(classes, "vector-classes")
    coded = classes.select("rep", "copies", "vector").mapInArrow(
        _codes(bits, tables, SEED), f"rep long, copies long, vector {classes.schema['vector'].dataType.simpleString()}, codes array<long>"
    )
    coded = materialize(coded, "vector-codes")
    labelled = coded.join(classes.select("rep", "label", F.size("vector").alias("dim")), "rep")
    each = labelled.select("rep", "label", "dim", F.posexplode("codes").alias("at", "code")).select(
        "rep", F.xxhash64("label", "dim", "at", "code").alias("bucket"), "at"
    )
    each = materialize(each, "vector-buckets")
    shared = each.groupBy("bucket", "at").count().where("count > 1")
    shared = shared.select("bucket", "at", F.ceil(F.col("count") / block).alias("blocks"))
    member = each.join(materialize(shared, "shared-buckets"), ["bucket", "at"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    member = member.select("rep", "bucket", "at", "block", other).select(
        "rep", "bucket", "at", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    by = ["bucket", "at", "left", "right"]
    met = member.join(coded, "rep").repartition(*by).sortWithinPartitions(*by)
    found = materialize(met.mapInArrow(_links(threshold), "rep long, links long, root long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    about = (
        classes.select("same1", "same2", "rep", "copies")
        .join(links, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "same1",
            "same2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    out = narrow.join(materialize(about, "vector-components"), ["same1", "same2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
