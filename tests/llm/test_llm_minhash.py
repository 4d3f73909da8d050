import random

import pytest
from llm_frames import awkward, documents, nothing

from wattline.llm import minhash
from wattline.llm.components import components


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """Components by comparing all pairs; rows with one id are one document."""
    sets, root = [shingles(t) for _, t in rows], {}
    top = lambda i: i if root.setdefault(i, i) == i else top(root[i])
    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows):
            if a < b and i is not None and j is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    return sorted(((i, len(s), None if i is None else top(i), i is None or top(i) == i) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def found(docs, **options):
    return sorted(map(tuple, minhash.near_duplicates(docs, **options).collect()), key=str)


def changed(draw, words, n):
    out = list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**9)}"
    return out


def test_equals_all_pairs(spark):
    draw, rows = random.Random(9), []
    word = lambda: f"w{draw.randrange(3000)}"
    for _ in range(25):
        base = [word() for _ in range(draw.choice([3, 6, 40, 200]))]
        rows.append(base)
        rows += [changed(draw, base, draw.choice([0, 1, 2, 4])) for _ in range(draw.randint(0, 6))]
    # Many edited copies of one text, each further from the others than from the text itself.
    base = [word() for _ in range(150)]
    rows += [changed(draw, base, 4) for _ in range(40)] + [base] + [changed(draw, base, 4) for _ in range(40)]
    # A passage that many otherwise different texts share.
    passage = [word() for _ in range(60)]
    rows += [passage + [word() for _ in range(40)] for _ in range(30)]
    draw.shuffle(rows)
    texts = [(i, " ".join(r)) for i, r in enumerate(rows)]
    assert found(documents(spark, [(i, t, "a") for i, t in texts])) == plain(texts)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert found(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert found(nothing(spark)) == []
    kept = minhash.drop_near_duplicates(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 7, 8, 10, None}
    assert minhash.drop_near_duplicates(nothing(spark)).count() == 0


def test_repeated_ids_of_different_texts_lose_no_text(spark):
    draw = random.Random(12)
    a, b, c, d = ([f"w{draw.randrange(10**6)}" for _ in range(80)] for _ in range(4))
    rows = [(3, b), (5, a), (5, b), (7, a), (8, c), (9, changed(draw, c, 1)), (9, d), (11, d)]
    texts = [(i, " ".join(t)) for i, t in rows]
    docs = documents(spark, [(i, t, "a") for i, t in texts])
    kept = sorted((r.doc_id, r.text) for r in minhash.drop_near_duplicates(docs).collect())
    assert kept == sorted(texts[k] for k in (0, 1, 4, 6))
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()) == [
        (3, 3), (5, 3), (5, 5), (7, 5), (8, 8), (9, 8), (9, 9), (11, 9),
    ]


def test_tables_come_from_few_values():
    signer = minhash.Signer()
    assert len(signer.flips) == 2 * minhash.SIDE * minhash.ROWS < minhash.SIDE**2
    a = minhash.Shingler()([b"a b c d e f g h", b"A b\tc d  e f g h", b"a b"])
    assert (a[0] == a[1]).all() and (signer(a[0]) == signer(a[1])).all() and len(a[2]) == 1


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(4)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(80)] + [(700, 701), (3, 3), (900, 900)],
        "random": [(draw.randrange(300), draw.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    root = {}
    top = lambda i: i if root.setdefault(i, i) == i else top(root[i])
    for a, b in edges:
        if a != b:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == sorted((i, top(i)) for i in list(root))
