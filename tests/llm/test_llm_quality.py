import zlib

import numpy as np
from llm_frames import LONG, awkward, documents, nothing
from pyspark.sql import functions as F

from wattline.llm import quality
from wattline.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int, text string"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, 0, "own") for i, q in rows], LABELS)


def test_counts_equal_counting_one_by_one():
    texts = ["Ab, the the 12%% naïve", "", " \n", "the Ab, x", "a b a b a b", "Ab,"]
    rows = quality.counts([t.encode() for t in texts])
    for t, row in zip(texts, rows, strict=True):
        alone = np.zeros(quality.COLUMNS)
        words = t.encode().split()
        for w in words:
            buckets, starts = quality.word_features([w])
            assert starts.tolist() == [0, len(buckets)] and len(buckets) >= 1 + len(w)
            np.add.at(alone, buckets, 1)
        if words:
            near = [sum(a == b for a, b in zip(words, words[k:], strict=False)) for k in (1, 2)]
            even = sum(words.count(w) ** 2 for w in set(words)) / len(words)
            alone[quality.FEATURES :] = [quality.REPEAT_WEIGHT * x for x in (*near, even)]
        assert np.allclose(row, alone)


def test_blocks_of_words_do_not_change_counts(monkeypatch):
    texts = [f"word{k} and word{k % 7} again {k}".encode() * 3 for k in range(50)]
    whole = quality.counts(texts)
    monkeypatch.setattr(quality, "PAIRS", 3)
    assert np.allclose(quality.counts(texts), whole)


def test_votes_equal_all_products():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, 30)).encode() for _ in range(600)]
    projection = rng.standard_normal((quality.COLUMNS, 8)).astype(np.float32)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    near = unit(rng.standard_normal((300, 8)).astype(np.float32))
    model = quality.Model(projection, near, rng.integers(0, 2, 300).astype(np.float32), 0.5)
    cosines = np.maximum(unit(quality.counts(texts) @ projection) @ near.T, 0).astype(float)
    best = np.argsort(-cosines, axis=1)[:, : quality.NEIGHBOURS]
    weights = np.take_along_axis(cosines, best, axis=1) ** quality.POWER
    wanted = (weights * model.labels[best]).sum(axis=1) / weights.sum(axis=1)
    assert np.allclose(quality.scores(texts, model), wanted, atol=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op8_quality"](spark, folder).collect()}
    truth = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null").collect()
    assert {i for i, r in rows.items() if r.held_out} == {i for i in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    tested = [(t.quality, rows[t.doc_id].predicted) for t in truth if rows[t.doc_id].held_out]
    assert len(tested) > 80
    assert np.mean([p == q for q, p in tested]) >= 0.97
    assert np.mean([p == 1 for q, p in tested if q == 1]) >= 0.98


def test_held_out_labels_teach_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    known = spark.read.parquet(f"{small}/labels.parquet")
    turned = known.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit_on_labels(docs, x) for x in (known, turned))
    assert (a.neighbours == b.neighbours).all() and (a.labels == b.labels).all()


def scored(docs, model):
    return {r.doc_id: r.s for r in docs.select("doc_id", quality.with_score(docs, model, F.col("text")).alias("s")).collect()}


def test_awkward_rows(spark):
    docs = awkward(spark)
    known = labels(spark, [(4, 0), (5, 1), (6, 1), (None, 1), (7, None), (3, 0), (999, 0)])
    model = quality.fit_on_labels(docs.select("doc_id", "text"), known)
    found = scored(docs, model)
    assert all(0 <= s <= 1 for s in found.values())
    assert found[1] == found[2] == found[3] == model.prior
    assert scored(documents(spark, [(1, LONG, "a")]), model)[1] == found[4]
    empty = quality.fit_on_labels(nothing(spark).select("doc_id", "text"), labels(spark, []))
    assert set(scored(docs, empty).values()) == {0.5}
    assert scored(nothing(spark), model) == {}


def test_the_sample_is_bounded(spark):
    docs = documents(spark, [(i, f"text number {i}", "a") for i in range(60)] * 2)
    model = quality.fit(docs.select("doc_id", "text"), labels(spark, [(i, i % 2) for i in range(60)]).withColumnRenamed("quality", "label"), max_labelled=20)
    assert len(model.labels) == 20
