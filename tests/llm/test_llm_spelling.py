import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_frames import awkward, nothing
from pyspark.sql import functions as F

from wattline.llm import spelling
from wattline.llm.queries import QUERIES


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words, ratio=2):
    """Rows of `variants` by comparing all words with all."""
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) if vs else None for w, vs in near.items()}
    form = {w: b if b is not None and words[b] >= ratio * words[w] else None for w, b in best.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def vocabulary(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def found(spark, words):
    rows = spelling.variants(vocabulary(spark, words)).collect()
    assert len(rows) == len(words)
    return {tuple(r) for r in rows}


def drawn(seed, many, letters="abé", longest=9):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randint(1, longest))) for _ in range(many)}
    return {w: draw.choice([3, 3, 4, 6, 12, 24, 100]) for w in words}


@pytest.mark.parametrize("bound", [1 << 14, 40, 1])
def test_equals_comparing_all_words(spark, monkeypatch, bound):
    monkeypatch.setattr(spelling, "GROUP_LETTERS", bound)
    words = drawn(bound, 400)
    assert found(spark, words) == plain(words)


def test_one_group_of_many_words(spark, monkeypatch):
    """Words that agree in their first and last letters are split until groups are small, and none of them is lost."""
    monkeypatch.setattr(spelling, "GROUP_LETTERS", 600)
    words = {f"prefix{w}suffix": n for w, n in drawn(5, 700, "abcdef", 4).items()}
    stored = vocabulary(spark, words)
    sizes = spelling.groups(stored).groupBy(spelling.GROUP).count()
    assert sizes.where("count * (high - low) > 600 and high - low > 1").count() == 0
    assert found(spark, words) == plain(words)


def test_very_long_words(spark):
    long = "abcdefghij" * 5_000
    words = {long: 40, long + "x": 3, "x" + long: 5, long[:25_000] + "z" + long[25_001:]: 9, long[:25_000] + long[25_001:]: 8, "other": 3}
    rows = {r.word: r for r in spelling.variants(vocabulary(spark, words)).collect()}
    assert [rows[w].form for w in words] == [None, long, long, long, long, None]
    # The word without its middle letter is also one letter from the one with another letter there.
    assert [rows[w].n_near for w in words] == [4, 1, 1, 2, 2, 0]


def test_forms_lead_to_roots(spark):
    chain = {"aaaaa": 100, "aaaab": 40, "aaabb": 20, "aabbb": 10, "abbbb": 5, "bbbbb": 2, "ccccc": 5, "ccccd": 5}
    rows = {r.word: (r.form, r.root, r.form_n) for r in spelling.variants(vocabulary(spark, chain)).collect()}
    assert rows["bbbbb"] == ("abbbb", "aaaaa", 5)
    assert rows["aaaaa"] == (None, "aaaaa", None)
    # Twice as frequent is what a form must be.
    assert rows["ccccc"] == (None, "ccccc", None)


def test_ties_go_to_the_smallest_word(spark):
    rows = {r.word: r.form for r in spelling.variants(vocabulary(spark, {"words": 1, "wordé": 9, "wordz": 9, "worda": 9})).collect()}
    assert rows["words"] == "worda"


def test_blocks_of_any_size_give_the_same(monkeypatch):
    words = sorted(w for w in drawn(9, 300, "ab", 8) if len(w) in (6, 7))
    rows = sorted((6, 3, 7, w[:3], w, 5) for w in words)
    batches = [pa.RecordBatch.from_pydict(dict(zip([*spelling.GROUP, "word", "n"], zip(*rows[i : i + 7])))) for i in range(0, len(rows), 7)]

    def links():
        return {tuple(r.values()) for b in spelling._near(iter(batches)) for r in b.to_pylist()}

    whole = links()
    assert whole
    monkeypatch.setattr(spelling, "BLOCK", 3)
    assert links() == whole


def test_each_pair_is_found_in_one_window():
    words = sorted(drawn(3, 200, "ab", 6))
    for size in range(1, 7):
        own = [w for w in words if len(w) in (size, size + 1)]
        if not any(len(w) == size for w in own):
            continue
        pairs = Counter()
        for low in range(size + 1):
            for outer in {w[:low] + w[len(w) - max(0, size - low - 1) :] for w in own}:
                group = [w for w in own if w[:low] + w[len(w) - max(0, size - low - 1) :] == outer]
                if any(len(w) == size for w in group):
                    a, b = spelling.near_in_block(group, np.zeros(len(group), int), size, low, low + 1)
                    pairs.update((group[i], group[j]) for i, j in zip(a.tolist(), b.tolist()))
        wanted = {(a, b) for a in own for b in own if one_apart(a, b) and min(len(a), len(b)) == size}
        assert set(pairs) == wanted and set(pairs.values()) <= {1}


def test_runs_and_slips(spark):
    texts = [(1, "Hello wörld ÀB x", None), (None, "Straße naïve×test ab", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, run string")
    rows = {(r.doc_id, r.run) for r in spelling.runs(docs, least=2).collect()}
    assert rows == {(1, "hello"), (1, "wörld"), (1, "Àb"), (None, "straße"), (None, "naïve×test"), (None, "ab")}
    draw = random.Random(1)
    many = [(i, "".join(draw.choices("abcß", k=6))) for i in range(400)]
    frame = spark.createDataFrame(many, "doc_id long, run string")
    slipped = frame.select("doc_id", "run", spelling.with_slips(F.col("doc_id"), F.col("run"), 7).alias("w")).collect()
    changed = 0
    for r in slipped:
        h = zlib.crc32(f"{r.doc_id}:{r.run}".encode())
        k = h % len(r.run)
        assert r.w == (r.run[:k] + r.run[k + 1 :] if h % 7 == 0 else r.run)
        changed += r.w != r.run
    assert changed


def test_awkward_rows_and_tables(spark):
    words = spelling.runs(awkward(spark), least=5).select(F.col("run").alias("word"))
    rows = spelling.variants(spelling.vocabulary(words)).collect()
    counts = Counter(m.lower() for r in awkward(spark).collect() for m in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""))
    assert {(r.word, r.n) for r in rows} == {(w, n) for w, n in counts.items() if n >= 3 and len(w) >= 5}
    none = spelling.runs(nothing(spark)).select(F.col("run").alias("word"))
    assert spelling.variants(spelling.vocabulary(none)).collect() == []


def test_query_equals_comparing_all_words(spark, small):
    counts = Counter()
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    assert {tuple(r) for r in QUERIES["op12_spelling_variants"](spark, small).collect()} == plain(words)
