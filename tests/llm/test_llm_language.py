import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_frames import LONG, awkward, documents, nothing
from pyspark.sql import functions as F

from wattline.llm import language
from wattline.llm.queries import QUERIES


def plain_grams(text):
    """Counts of n-grams, each a tuple of three with None where it is shorter."""
    signs = []
    for c in text:
        kind = unicodedata.category(c)[0]
        low = c.lower() if kind == "L" and len(c.lower()) == 1 else c
        signs.append(low if kind in "LM" else " ")
    if not any(unicodedata.category(c)[0] == "L" for c in text):
        return Counter()
    found = Counter()
    for word in "".join(signs).split():
        padded = f" {word} "
        found.update((None, None, c) for c in word)
        found.update((None, a, b) for a, b in zip(padded, padded[1:]))
        found.update(t for t in zip(padded, padded[1:], padded[2:]))
    return found


def ranked(counts, size):
    last = chr(0x10FFFF)
    key = lambda g: tuple(last if c is None else "" if c == " " else c for c in g)
    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:size]


def plain_model(rows, size):
    totals = {}
    for text, lang in rows:
        totals.setdefault(lang, Counter()).update(plain_grams(text))
    return {lang: {g: i for i, g in enumerate(ranked(c, size))} for lang, c in totals.items()}


def plain_answer(text, model, size):
    own = ranked(plain_grams(text or ""), size)
    if not own or not model:
        return "und", 0.0
    best, lang = min((sum(abs(i - p[g]) if g in p else size for i, g in enumerate(own)), lang) for lang, p in model.items())
    return lang, 1 - best / (size * len(own))


def test_query_equals_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    model = plain_model([(r.text, r.lang) for r in docs if not out(r.doc_id) and r.lang and r.text], language.SIZE)
    wanted = {r.doc_id: (out(r.doc_id), *plain_answer(r.text, model, language.SIZE)) for r in docs}
    found = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in QUERIES["op11_language"](spark, small).collect()}
    assert found == wanted


def test_held_out_documents_are_recognised(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op11_language"](spark, folder).where("held_out").join(truth, "doc_id")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.98


def test_awkward_rows_and_tables(spark):
    docs = awkward(spark)
    model = language.fit(docs.withColumn("lang", F.when(F.col("doc_id") < 8, "en").when(F.col("doc_id") == 10, "xx")))
    assert model.languages == ["en", "xx"]
    rows = docs.select("doc_id", "text", language.with_language(docs, model, F.col("text")).alias("f")).collect()
    assert len(rows) == 13
    for r in rows:
        if not any(unicodedata.category(c)[0] == "L" for c in r.text or ""):
            assert tuple(r.f) == ("und", 0.0)
        else:
            assert r.f.lang in ("en", "xx") and 0 <= r.f.score <= 1
        if r.text == LONG:
            assert r.f.lang == "en"
        if r.doc_id == 10:
            assert r.f.lang == "xx"
    empty = language.fit(nothing(spark))
    assert empty.languages == []
    assert [tuple(r.f) for r in documents(spark, [(1, "some words", None)]).select(
        language.with_language(docs, empty, F.col("text")).alias("f")).collect()] == [("und", 0.0)]
    assert nothing(spark).select(language.with_language(docs, model, F.col("text"))).count() == 0


def test_marks_digits_and_case():
    assert len(language.letters("123 ... ́")) == 0
    assert language.letters("Ab1É").tolist() == [0, ord("a"), ord("b"), 0, ord("é"), 0]
    # A mark on a letter stays with it.
    assert language.letters("é").tolist() == [0, ord("e"), 0x301, 0]


def test_equal_distances_go_to_the_smallest_name():
    own = language.profile(language.counted(language.letters("same words")), 50).tolist()
    model = language.Model.of({"b": own, "a": own, "c": own}, 50)
    assert model.predict("same words") == ("a", 1.0)


def test_stretches_add_up(monkeypatch):
    codes = language.letters("The quick brown fox, jumps over the lazy dog. " * 20)
    whole = language.counted(codes)
    monkeypatch.setattr(language, "STRETCH", 7)
    for a, b in zip(language.counted(codes), whole):
        assert np.array_equal(a, b)


def test_counts_passed_on_early_are_the_same(monkeypatch):
    texts = ["alpha beta", "gamma delta", "alpha", "", "épsilon"]
    batch = pa.RecordBatch.from_pydict({"lang": ["x", "y", "x", "x", "y"], "text": texts})

    def totals():
        found = Counter()
        for part in language._counts(iter([batch, batch])):
            for lang, gram, n in zip(*(part.column(c).to_pylist() for c in ("lang", "gram", "n"))):
                found[lang, gram] += n
        return found

    whole = totals()
    monkeypatch.setattr(language, "HELD", 3)
    monkeypatch.setattr(language, "SLICE_BYTES", 8)
    assert totals() == whole


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    many = spark.createDataFrame([(f"l{i}", "abc def ghi") for i in range(40)], "lang string, text string")
    with pytest.raises(ValueError, match="languages"):
        language.fit(many, size=5)
