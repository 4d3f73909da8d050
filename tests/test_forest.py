import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.operators import features, forest
from wattline.session import materialize

COLS = ["x", "y"]
KEYS = ["id"]
SMALL = dict(trees=50, sample=128, cols=COLS, keys=KEYS)


@pytest.fixture(scope="module")
def cloud(spark):
    """A round cloud of 4,000 points with four far ones (ids below 4)."""
    noise = lambda salt: f"(pmod(xxhash64(id, {salt}), 10000) + pmod(xxhash64(id, {salt + 1}), 10000)) / 10000.0D"
    df = spark.range(4000).selectExpr("id", f"{noise(1)} as x", f"{noise(5)} as y")
    far = F.col("id") < 4
    df = df.withColumns({"x": F.when(far, 9.0).otherwise(F.col("x")), "y": F.when(far, -7.0).otherwise(F.col("y"))})
    return materialize(df)


def test_far_points_come_first(cloud):
    got = forest.forest_scores(cloud, **SMALL)
    top = got.orderBy(F.desc("risk_score")).limit(4).collect()
    assert {r.id for r in top} == {0, 1, 2, 3}
    assert all(r.isolation_prediction == -1 for r in top)


def test_flagged_share_is_the_contamination(cloud):
    got = forest.forest_scores(cloud, **SMALL)
    share = got.filter("isolation_prediction = -1").count() / 4000
    assert 0.07 < share <= 0.0801
    assert got.filter("(isolation_score < 0) != (isolation_prediction = -1)").isEmpty()
    assert got.filter("risk_score != -isolation_score").isEmpty()


def test_scores_do_not_depend_on_partitions(cloud):
    a = forest.forest_scores(cloud.repartition(1), **SMALL).select("id", F.round("risk_score", 12))
    b = forest.forest_scores(cloud.repartition(11), **SMALL).select("id", F.round("risk_score", 12))
    assert a.exceptAll(b).isEmpty()


def test_scaling_changes_nothing(cloud):
    a = forest.forest_scores(cloud, **SMALL).select("id", F.round("risk_score", 9))
    b = forest.forest_scores(features.standardize(cloud, COLS), **SMALL).select("id", F.round("risk_score", 9))
    assert a.exceptAll(b).isEmpty()


def test_seed_matters(cloud):
    a = forest.forest_scores(cloud, **SMALL, seed=1).agg(F.max("risk_score")).first()[0]
    b = forest.forest_scores(cloud, **SMALL, seed=2).agg(F.max("risk_score")).first()[0]
    assert a != b


def lowest(rows, tree, sample, seed):
    """The sample of a tree by sorting all rows."""
    prime = 2**31 - 1
    factor, shift = 1 + forest._digest(seed, tree, "factor") % (prime - 1), forest._digest(seed, tree, "shift") % prime
    keyed = [((factor * (h % prime) + shift) % prime, h, *x) for h, *x in rows]
    return sorted(keyed)[:sample]


@pytest.mark.parametrize("parts", [1, 7])
def test_samples_are_the_lowest_hashes_of_all_rows(cloud, parts):
    rows = [tuple(r) for r in cloud.select(forest._row_hash(42, KEYS), *COLS).collect()]
    drawn = forest.tree_samples(cloud.repartition(parts), COLS, KEYS, 20, 16, 42)
    found = {}
    for r in drawn.collect():
        found.setdefault(r.tree_id, []).append(tuple(r)[1:])
    # Every task sends each tree no more than its sample.
    assert all(len(own) <= 16 * parts for own in found.values())
    for tree in range(20):
        assert sorted(found[tree])[:16] == lowest(rows, tree, 16, 42)


def test_samples_do_not_depend_on_how_rows_arrive(monkeypatch):
    draw = np.random.default_rng(1)
    row, x = draw.integers(0, 1 << 52, 3000), np.round(draw.normal(size=(3000, 2)), 1)
    row[:500] = row[500:1000]  # equal keys go by the features
    whole = forest._Lowest(9, 32, 5)
    whole.add(row, x)
    wanted = whole.shrink()
    for chunk in (40, 300):
        monkeypatch.setattr(forest, "_CHUNK", chunk)
        parts = forest._Lowest(9, 32, 5)
        for block in np.array_split(draw.permutation(3000), 11):
            parts.add(row[block], x[block])
        assert all(np.array_equal(a, b) for a, b in zip(parts.shrink(), wanted))


def test_the_forest_takes_one_scan(cloud):
    plan = forest.grow_forest(cloud, COLS, 20, 16, 42, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "Window" not in plan and "Aggregate" not in plan


def test_a_stored_forest_scores_other_tables(spark, cloud):
    nodes = materialize(forest.grow_forest(cloud, COLS, 50, 128, 42, KEYS), "forest")
    assert nodes.count() <= 50 * 255
    own = forest.forest_scores(cloud, **SMALL).select("id", "risk_score")
    assert own.exceptAll(forest.forest_scores(cloud, cols=COLS, keys=KEYS, nodes=nodes).select("id", "risk_score")).isEmpty()
    other = spark.createDataFrame([(1, 9.0, -7.0), (2, 1.0, 1.0)], "id long, x double, y double")
    scored = {r.id: r.outlier_score for r in forest.outliers(other, cols=COLS, keys=KEYS, nodes=nodes).collect()}
    same = {r.id: r.outlier_score for r in forest.outliers(cloud, **SMALL).where("id = 0").collect()}
    assert scored[1] == same[0] > 0.6 > 0.5 > scored[2]


def test_fewer_rows_than_a_sample(spark):
    df = spark.range(5).selectExpr("id", "cast(id as double) as x", "1.0D as y")
    assert forest.forest_scores(df, **SMALL).count() == 5


def test_equal_rows(spark):
    df = spark.range(10).selectExpr("id", "2.0D as x", "1.0D as y")
    got = forest.forest_scores(df, **SMALL)
    assert {r.isolation_prediction for r in got.collect()} == {1}


def test_no_rows(spark):
    df = spark.range(0).selectExpr("id", "2.0D as x", "1.0D as y")
    with pytest.raises(ValueError):
        forest.fit_forest(df, COLS, keys=KEYS)


def test_path_lengths_by_walking_the_tree(spark):
    data = np.random.default_rng(0).normal(size=(64, 3))
    nodes = {n: (f, cut, path) for n, f, cut, path in forest.grow_tree(data, 3, 42)}

    def walk(row):
        at = 1
        while nodes[at][0] is not None:
            at = 2 * at + int(row[nodes[at][0]] > nodes[at][1])
        return nodes[at][2] / 1e6

    names = ["a", "b", "c"]
    rows = [(3, n, None if f is None else names[f], cut, path, 64) for n, (f, cut, path) in nodes.items()]
    model = forest.model_of(spark.createDataFrame(rows, forest.NODES))
    assert model.cols == ("a", "b", "c") and model.depth == 6
    got = forest.outlier_scores(data, *model.arguments())
    want = [2 ** (-walk(row) / forest.average_path(64)) for row in data]
    assert got == pytest.approx(want)
    assert max(p for *_, p in nodes.values() if p) <= round((6 + forest.average_path(64)) * 1e6)


def test_lowest_hashes_are_those_of_a_full_sort():
    """Equal keys and keys that agree modulo the prime go by hash and features, whatever the order of arrival."""
    chance = np.random.default_rng(5)
    row = chance.integers(0, 2**52, 30_000)
    row[:6_000] = row[6_000:12_000]
    row[12_000:15_000] = row[15_000:18_000] % forest._PRIME
    x = chance.integers(0, 3, (len(row), 3)).astype(float)
    lowest = forest._Lowest(7, 64, 42)
    for start in range(0, len(row), 5_000):
        lowest.add(row[start : start + 5_000], x[start : start + 5_000])
    found = [np.column_stack([c for c in lowest.shrink()])]
    expected = []
    for t in range(7):
        drawn = (lowest.factor[t] * (row % forest._PRIME) + lowest.shift[t]) % forest._PRIME
        order = np.lexsort((*x.T[::-1], row, drawn))[:64]
        expected.append(np.column_stack([np.full(64, t), drawn[order], row[order], x[order]]))
    assert np.array_equal(found[0], np.concatenate(expected))


def test_modulo_at_the_ends():
    p = forest._PRIME
    values = np.array([0, 1, p - 1, p, p + 1, 2 * p, 2**31, 2**32, 2**62 - 1, 2**62, (p - 1) * (p - 1) + p - 1, p * p])
    assert forest._modulo(values.copy()).tolist() == [int(v) % p for v in values]
