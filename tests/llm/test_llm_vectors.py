import numpy as np
import pytest

from wattline.llm import hyperplanes, vp_tree

LAYOUT = "vec_id long, embedding array<float>, label int, place string, rank string, bucket string, same1 string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", "own", "own") for r in rows], LAYOUT)


def crowd(n, dim, seed, copies=0):
    """Random vectors, near ones among them, and `copies` equal ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(dim).astype(np.float32)
        if i % 3 == 2:
            v = (np.array(rows[-1][1], np.float32) + rng.standard_normal(dim) * 0.1).astype(np.float32)
        rows.append((i, v.tolist(), int(i % 30 > 14)))
    return rows + [(n + k, rows[0][1], rows[0][2]) for k in range(copies)]


BAD = [
    (None, [1.0, 0.0, 0.0], 0), (900, None, 0), (901, [], 0), (902, [0.0, 0.0, 0.0], 0), (903, [1.0, None, 0.0], 0),
    (904, [float("nan"), 1.0, 0.0], 0), (905, [float("inf"), 1.0, 0.0], 0), (906, [1.0, 1.0], 0), (907, [1.0, 0.0, 0.0], None),
    (920, [1.0, 0.0, 0.0], 0), (940, [2.0, 0.0, 0.0], 0), (940, [2.0, 0.0, 0.0], 0),
]


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def nearest(rows, k):
    out = []
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and good(v)]
    for q, a in usable:
        if q % 20:
            continue
        scored = []
        for i, b in usable:
            if i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    total += x * y
                scored.append((-total, i))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("leaf,shard_rows,query_rows", [(4, 100, 5), (16, 10_000, 10_000)])
def test_factor_one_is_exact(spark, monkeypatch, leaf, shard_rows, query_rows):
    monkeypatch.setattr(vp_tree, "LEAF", leaf)
    rows = crowd(400, 8, 1, copies=90)
    trees = vp_tree.build(vectors(spark, rows), shard_rows=shard_rows)
    asked = vectors(spark, [r for r in rows if r[0] % 20 == 0])
    found = vp_tree.search(trees, asked, k=20, query_rows=query_rows)
    assert sorted(map(tuple, found.collect())) == nearest(rows, 20)


def test_recall_and_savings_of_a_larger_factor():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 4)) * 8
    points = centres[rng.integers(0, 30, 4000)] + rng.standard_normal((4000, 4))
    part = __import__("pandas").DataFrame({"shard": 0, "dim": 4, "vec_id": np.arange(4000), "vector": list(points)})
    tree = vp_tree._build(part.assign(longest=float((points**2).sum(axis=1).max())))
    looked = {}

    class Counting(vp_tree._Search):
        def _products(self, who, lo, hi):
            looked[self.factor] = looked.get(self.factor, 0) + len(who) * (hi - lo)
            return super()._products(who, lo, hi)

    arrays = tree["vec_id"].to_numpy(), np.stack(tree["vector"]), tree["gap"].to_numpy(), np.stack(tree["bounds"])
    asks = points[:200]
    exact, loose = (Counting(*arrays, asks, np.arange(200), 10, f).found for f in (1.0, 1.5))
    scores = asks @ points.T
    scores[np.arange(200), np.arange(200)] = -np.inf
    assert (np.sort(exact) == np.sort(np.argsort(-scores, axis=1)[:, :10])).all()
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, loose, strict=True)])
    assert looked[1.5] < looked[1.0] < 200 * 4000 and recall >= 0.9


def test_copies_of_double_vectors_stay_exact(monkeypatch):
    monkeypatch.setattr(vp_tree, "LEAF", 8)
    wrong = []
    for seed in range(40):
        rng = np.random.default_rng(seed)
        points = rng.standard_normal((900, 16))
        points /= np.linalg.norm(points, axis=1)[:, None]
        points[rng.permutation(900)[:300]] = points[0]
        part = __import__("pandas").DataFrame({"shard": 0, "dim": 16, "vec_id": np.arange(900), "vector": list(points)})
        tree = vp_tree._build(part.assign(longest=float((points**2).sum(axis=1).max())))
        arrays = tree["vec_id"].to_numpy(), np.stack(tree["vector"]), tree["gap"].to_numpy(), np.stack(tree["bounds"])
        asked = np.flatnonzero((points == points[0]).all(axis=1))[::30]
        asked = np.concatenate([asked, np.arange(1, 900, 90)])
        found = vp_tree._Search(*arrays, points[asked], asked, 20, 1.0).found
        scores = np.zeros((len(asked), 900))
        for a, b in zip(points[asked].T, points.T, strict=True):
            scores += a[:, None] * b
        scores[np.arange(len(asked)), asked] = -np.inf
        if (found != np.argsort(-scores, axis=1, kind="stable")[:, :20]).any():
            wrong.append(seed)
    assert not wrong


def test_search_of_awkward_rows(spark):
    found = vp_tree.search(vp_tree.build(vectors(spark, BAD)), vectors(spark, [r for r in BAD if r[0] is not None and r[0] % 20 == 0]))
    assert {(r.query_id, r.vec_id, r.score) for r in found.collect()} == {(q, i, s) for q, _, i, s in nearest(BAD, 20)}
    none = vectors(spark, [])
    assert vp_tree.search(vp_tree.build(none), none).count() == 0


def components(rows, threshold=0.98):
    """Links and smallest reachable id by comparing all pairs."""
    n, use = len(rows), [i for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and good(r[1])]
    links, root = [0] * n, list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in use:
        for y in use:
            a, b = (np.array(rows[k][1], float) for k in (x, y))
            if x != y and rows[x][2] == rows[y][2] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[x] += 1
                root[top(x)] = top(y)
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [rows[j][0] for j in use if top(j) == top(k)] if k in use else [i]
        out.append((i, links[k], min(ids) if i is not None else None, i is None or min(ids) == i))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [8, 1024])
def test_links_equal_all_pairs(spark, block):
    rows = crowd(500, 16, 2, copies=60)
    found = hyperplanes.near_vectors(vectors(spark, rows), block=block)
    wanted = components(rows)
    assert sorted(map(tuple, found.collect()), key=str) == wanted
    assert sum(r[1] for r in wanted) > 60 * 60


def test_links_of_awkward_rows(spark):
    found = sorted(map(tuple, hyperplanes.near_vectors(vectors(spark, BAD)).collect()), key=str)
    assert found == components(BAD)
    assert hyperplanes.near_vectors(vectors(spark, [])).count() == 0
