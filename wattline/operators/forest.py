"""Isolation forest grown and applied on executors.

After Liu, Ting, Zhou, "Isolation Forest", ICDM 2008. Each tree is grown by one
task from at most a few hundred rows, so the model has a fixed size whatever the
data; scoring is one vectorised pass over the feature columns. The rows of a tree
are those with its lowest hashes, a sample that tasks draw apart and merge, and
all chance is a hash too: the forest follows from the rows and the seed. It is a
table of nodes that can be stored, and score another table later.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.quantiles import attach_scalars, exact_quantiles
from wattline.operators.features import sanitize
from wattline.operators.risk import SCENARIO_LIMITS, TIER_SHARES, tier, with_flags
from wattline.schemas import CUSTOMER_KEYS, MODEL_FEATURES
from wattline.session import materialize

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES, SAMPLE, SEED, CONTAMINATION = 200, 256, 42, 0.08
_EULER_GAMMA = 0.5772156649015329
#: Hashes that draw rows are taken modulo this prime, so that products of two stay whole numbers of 64 bits.
_PRIME = 2**31 - 1
#: Paths are kept in whole millionths, so that their sums do not depend on any order; scores have this many decimals.
_MILLION, _DECIMALS = 1_000_000, 9

#: Node 1 is the root; the lower child of node n is 2 n, the upper one 2 n + 1. A leaf has no feature but a path.
NODES = "tree_id INT, node INT, feature STRING, threshold DOUBLE, path LONG, sample INT"
_CHUNK = 2048


def average_path(n: int) -> float:
    """Mean depth at which a search among n values ends without a match."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _digest(*parts: object) -> int:
    """52 bits that follow from the parts, the same everywhere that md5 is known."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16)


def grow_tree(rows: np.ndarray, tree: int, seed: int) -> list[tuple]:
    """Split on a random feature at a random point until rows are alone.

    Nodes are (node, feature, threshold, path). Chance is a hash of seed, tree
    and node, so a tree follows from its rows wherever it is grown.
    """
    limit = max(1, math.ceil(math.log2(max(len(rows), 2))))
    nodes, waiting = [], [(1, rows, 0)]
    while waiting:
        node, members, depth = waiting.pop()
        low, high = members.min(axis=0), members.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(members) <= 1 or len(varying) == 0:
            nodes.append((node, None, None, round((depth + average_path(len(members))) * _MILLION)))
            continue
        which, where = (_digest(seed, tree, node, kind) / 2**52 for kind in ("feature", "threshold"))
        feature = int(varying[int(which * len(varying))])
        cut = float(low[feature] + where * (high[feature] - low[feature]))
        if cut >= high[feature]:  # rounded up to the maximum
            cut = float(low[feature])
        above = members[:, feature] > cut
        nodes.append((node, feature, cut, None))
        waiting += [(2 * node, members[~above], depth + 1), (2 * node + 1, members[above], depth + 1)]
    return nodes


def outlier_scores(
    x: np.ndarray,
    feature: np.ndarray,
    threshold: np.ndarray,
    below: np.ndarray,
    path: np.ndarray,
    depth: int,
    sample: int,
) -> np.ndarray:
    """2^(-mean path / expected path): near 1 is an outlier, near 0.5 ordinary.

    Rows go in chunks that stay in the processor cache.
    """
    x = np.ascontiguousarray(x)
    total = np.zeros(len(x))
    for start in range(0, len(x), _CHUNK):
        part = x[start : start + _CHUNK]
        flat, row = part.ravel(), np.arange(len(part)) * part.shape[1]
        for t in range(len(feature)):
            at = np.zeros(len(part), dtype=np.intp)
            for _ in range(depth):
                value = flat.take(row + feature[t].take(at))
                at = below[t].take(at) + (value > threshold[t].take(at))
            total[start : start + _CHUNK] += path[t].take(at)
    expected = average_path(sample) or 1.0
    return np.power(2.0, -(total / (len(feature) * _MILLION)) / expected)


@dataclass(frozen=True)
class ForestModel:
    """Node arrays of shape (trees, nodes), leaf paths in millionths, and the depth to walk.

    A leaf is its own lower child behind an endless threshold, so scoring takes
    the same number of plain steps for every row.
    """

    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    path: np.ndarray
    depth: int
    sample: int
    cols: tuple[str, ...]

    def arguments(self) -> tuple:
        return (self.feature, self.threshold, self.below, self.path, self.depth, self.sample)


def model_of(nodes: DataFrame) -> ForestModel:
    """The model in a table of NODES, at most trees x (2 x sample - 1) rows, 102,200 by default."""
    found = nodes.toPandas()
    if found.empty:
        raise ValueError("no rows to grow a forest from")
    trees, node = np.sort(found["tree_id"].unique()), found["node"].to_numpy()
    shape = (len(trees), int(node.max()))
    where = (np.searchsorted(trees, found["tree_id"].to_numpy()), node - 1)
    inner = found["feature"].notna().to_numpy()
    cols = tuple(sorted(found["feature"][inner].unique()))

    def table(values: np.ndarray, kind: type) -> np.ndarray:
        out = np.zeros(shape, dtype=kind)
        out[where] = values
        return out

    places = {c: i for i, c in enumerate(cols)}
    return ForestModel(
        table(found["feature"].map(places).fillna(0).to_numpy(), np.intp),
        table(np.where(inner, found["threshold"].to_numpy(), np.inf), np.float64),
        table(np.where(inner, 2 * node - 1, node - 1), np.intp),
        table(found["path"].fillna(0).to_numpy(), np.float64),
        int(node.max()).bit_length() - 1,
        int(found["sample"].iloc[0]),
        cols,
    )


def _row_hash(seed: int, keys: Sequence[str]) -> Column:
    text = F.concat_ws("|", F.lit(seed).cast("string"), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _modulo(x: np.ndarray) -> np.ndarray:
    """`x % _PRIME` of numbers from 0 to 2^62, by shifts: a division takes several times as long."""
    for _ in range(2):
        x = (x & _PRIME) + (x >> 31)
    x[x >= _PRIME] -= _PRIME
    return x


class _Lowest:
    """For every tree the rows with the lowest hashes so far, at most `sample` of them."""

    def __init__(self, trees: int, sample: int, seed: int):
        self.sample = sample
        self.factor = np.array([1 + _digest(seed, t, "factor") % (_PRIME - 1) for t in range(trees)])[:, None]
        self.shift = np.array([_digest(seed, t, "shift") % _PRIME for t in range(trees)])[:, None]
        self.limit = np.full((trees, 1), _PRIME)
        self.held: list[tuple[np.ndarray, ...]] = []

    def add(self, row: np.ndarray, x: np.ndarray) -> None:
        """Rows by their hashes and their features."""
        for start in range(0, len(row), _CHUNK):
            own, part = row[start : start + _CHUNK], x[start : start + _CHUNK]
            drawn = _modulo(self.factor * (own % _PRIME) + self.shift)
            # Later limits come from `shrink`, which sees more rows than a chunk has.
            if len(own) > self.sample and self.limit.max() == _PRIME:
                self.limit = np.minimum(self.limit, np.partition(drawn, self.sample - 1, axis=1)[:, self.sample - 1 :][:, :1])
            tree, at = np.nonzero(drawn <= self.limit)
            self.held.append((tree, drawn[tree, at], own[at], part[at]))
            if sum(len(h[0]) for h in self.held) > 4 * self.sample * len(self.factor):
                self.shrink()

    def shrink(self) -> tuple[np.ndarray, ...]:
        """What is held, by tree and hash; equal hashes of equal keys go by the features."""
        tree, drawn, row, x = (np.concatenate(c) for c in zip(*self.held, strict=True))
        key = (tree << 31) + drawn
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if len(tied):
            some = order[tied]
            order[tied] = some[np.lexsort((*x[some].T[::-1], row[some], key[some]))]
        tree, drawn, row, x = tree[order], drawn[order], row[order], x[order]
        place = np.arange(len(tree)) - np.searchsorted(tree, tree)
        last = place == self.sample - 1
        self.limit[tree[last], 0] = np.minimum(self.limit[tree[last], 0], drawn[last])
        kept = place < self.sample
        self.held = [(tree[kept], drawn[kept], row[kept], x[kept])]
        return self.held[0]


def tree_samples(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """(tree_id, drawn, row, *cols): of every task's rows those with the lowest hashes, at most `sample` for each tree.

    The lowest of them all make a tree's sample. A row's hash for a tree follows
    from its keys, so the sample follows from the rows and not from the tasks. One scan.
    """
    names = [f"c{i}" for i in range(len(cols))]
    schema = ", ".join(["tree_id INT", "drawn LONG", "row LONG", *[f"{n} DOUBLE" for n in names]])

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Lowest(trees, sample, seed)
        for batch in batches:
            if batch.num_rows:
                row, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                found.add(row, np.column_stack(x))
        if found.held:
            tree, drawn, row, x = found.shrink()
            columns = [pa.array(tree, pa.int32()), pa.array(drawn), pa.array(row), *[pa.array(c) for c in x.T]]
            yield pa.RecordBatch.from_arrays(columns, ["tree_id", "drawn", "row", *names])

    keyed = df.select(_row_hash(seed, keys).alias("row"), *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    return keyed.mapInArrow(lowest, schema)


def grow_forest(
    df: DataFrame,
    cols: Sequence[str] = MODEL_FEATURES,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
    keys: Sequence[str] = CUSTOMER_KEYS,
) -> DataFrame:
    """The table of NODES of a forest, to be stored: `model_of` makes it a model that scores any table with these columns."""
    names, features = [f"c{i}" for i in range(len(cols))], np.array(cols, dtype=object)

    def grow(group: pa.Table) -> pa.Table:
        tree = group.column("tree_id")[0].as_py()
        order = [("drawn", "ascending"), ("row", "ascending"), *[(n, "ascending") for n in names]]
        rows = group.sort_by(order).slice(0, sample)
        nodes = grow_tree(np.column_stack([rows.column(n).to_numpy() for n in names]), tree, seed)
        node, feature, threshold, path = zip(*nodes, strict=True)
        named = [None if f is None else features[f] for f in feature]
        columns = [[tree] * len(nodes), node, named, threshold, path, [rows.num_rows] * len(nodes)]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int64(), pa.int32()]
        parts = [f.split()[0] for f in NODES.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=parts)

    # Every task sends a tree at most `sample` rows, so a tree's group has that many for each task and no more.
    return tree_samples(df, cols, keys, trees, sample, seed).groupBy("tree_id").applyInArrow(grow, NODES)


def fit_forest(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES, **forest) -> ForestModel:
    """Grow the trees on executors and bring the stored node table to the driver."""
    return model_of(materialize(grow_forest(df, cols, **forest), "forest"))


def score_forest(df: DataFrame, model: ForestModel, prefix: str = "") -> DataFrame:
    """Add `outlier_score`; only the feature columns travel to Python, and `prefix` stands before their names in `df`."""
    shared = df.sparkSession.sparkContext.broadcast(model.arguments())

    @F.pandas_udf("double")
    def outlier(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        forest = shared.value
        for columns in batches:
            # A single column comes without a tuple around it.
            columns = columns if isinstance(columns, tuple) else (columns,)
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
            yield pd.Series(outlier_scores(x, *forest))

    if not model.cols:  # no column varies: every tree is one leaf
        same = outlier_scores(np.zeros((1, 1)), *model.arguments())[0]
        return df.withColumn("outlier_score", F.round(F.lit(float(same)), _DECIMALS))
    score = outlier(*[F.col(prefix + c) for c in model.cols])
    return df.withColumn("outlier_score", F.round(score, _DECIMALS))


def _decided(df: DataFrame) -> DataFrame:
    """Decision, prediction and risk score from `_s`, the negated outlier score, and `stats.offset`."""
    return (
        df.withColumn("isolation_score", F.col("_s") - F.col("stats.offset"))
        .withColumn("isolation_prediction", F.when(F.col("isolation_score") < 0, -1).otherwise(1))
        .withColumn("risk_score", -F.col("isolation_score"))
    )


def add_decision(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Decision value (negative = outlier), -1/1 prediction and risk score.

    The offset puts the given share of rows below zero.
    """
    negated = scored.withColumn("_s", -F.col("outlier_score"))
    offset = exact_quantiles(negated, {"offset": ("_s", contamination)})
    return attach_scalars(negated, offset).transform(_decided).drop("_s", "stats", "outlier_score")


def outliers(
    features: DataFrame,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
    cols: Sequence[str] = MODEL_FEATURES,
    keys: Sequence[str] = CUSTOMER_KEYS,
    nodes: DataFrame | None = None,
) -> DataFrame:
    """Features with the forest's `outlier_score`, stored for the passes that follow.

    The model reads sanitised copies of the columns; the result carries the
    originals. Scaling them first (`features.standardize`) would change nothing:
    cuts fall evenly between the smallest and the largest value, so any linear
    scaling grows the same trees. With stored `nodes` of an earlier forest these
    score the table and none is grown.
    """
    copies = {c: f"_z_{c}" for c in cols}
    inputs = sanitize(features.withColumns({z: F.col(c) for c, z in copies.items()}), list(copies.values()))
    if nodes is None:
        plain = sanitize(features.select(*keys, *[c for c in cols if c not in keys]), cols)
        nodes = materialize(grow_forest(plain, cols, trees, sample, seed, keys), "forest")
    scored = score_forest(inputs, model_of(nodes), "_z_")
    return materialize(scored.drop(*copies.values()), "forest-scores")


def forest_scores(features: DataFrame, contamination: float = CONTAMINATION, **forest) -> DataFrame:
    """Features with the forest's decision, prediction and risk score."""
    return add_decision(outliers(features, **forest), contamination)


def anomaly_scores(features: DataFrame, contamination: float = CONTAMINATION, **forest) -> DataFrame:
    """Forest scores, risk tiers and scenario flags over stored risk features.

    The risk score is the outlier score shifted by the offset, so its tiers can be cut at quantiles of the outlier score
    itself, and offset, tiers and flags take their seven quantiles from the same passes.
    """
    negated = outliers(features, **forest).withColumn("_s", -F.col("outlier_score"))
    wanted = {name: ("outlier_score", share) for name, share in TIER_SHARES.items()} | SCENARIO_LIMITS
    limits = exact_quantiles(negated, wanted | {"offset": ("_s", contamination)})
    decided = attach_scalars(negated, limits).transform(_decided).withColumn("anomaly_score", tier(F.col("outlier_score")))
    return decided.transform(with_flags).drop("_s", "stats", "outlier_score")
