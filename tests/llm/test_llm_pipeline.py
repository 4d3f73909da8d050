"""The pipeline against plain versions of its stages, and on awkward rows."""

import public_tokenizers
import test_llm_lines
import test_llm_minhash
from llm_frames import awkward, nothing
from pyspark.sql import functions as F

import corpus_pipeline
from wattline.llm import mixing, pieces
from wattline.llm.queries import QUERIES
from wattline.session import materialize


def test_stages_equal_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept, frames = docs, []
    for name, stage in corpus_pipeline.STAGES:
        kept = materialize(stage(spark, kept, small), "stage")
        frames.append(kept)
    good, lines, unique, mixed, coded = frames
    assert all(f.columns == docs.columns for f in frames[:4])
    pairs = lambda f: [(r.doc_id, r.text) for r in f.select("doc_id", "text").collect()]

    predicted = {r.doc_id for r in QUERIES["op8_quality"](spark, small).where("predicted = 1").collect()}
    assert {i for i, _ in pairs(good)} == predicted

    wanted = [(i, text) for i, _, _, text in test_llm_lines.plain(pairs(good))]
    assert sorted(pairs(lines)) == sorted(wanted)
    assert lines.where("n_chars <> length(text)").isEmpty()

    stays = {i for i, _, _, keep in test_llm_minhash.plain(pairs(lines)) if keep}
    assert sorted(pairs(unique)) == sorted((i, t) for i, t in wanted if i in stays)

    rows = mixing.keyed(unique)
    narrow = rows.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "key", "tie").cache()
    copies = {r.doc_id: r.copies for r in mixing.decide(narrow, mixing.cuts(narrow)).collect()}
    assert dict(mixed.groupBy("doc_id").count().collect()) == {i: n for i, n in copies.items() if n}

    texts, model = dict(pairs(unique)), pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    found = coded.collect()
    assert len(found) == sum(copies.values()) and all(r.same_text for r in found)
    assert all(model.decode(r.ids) == texts[r.doc_id] and len(r.ids) == r.n_tokens for r in found)


def test_awkward_rows(spark, small):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, small), "stage")
    assert docs.count() == 0


def test_run_is_registered(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line dedup", "near dedup", "mix", "token ids"]
    assert corpus_pipeline.run(spark, small).columns == ["doc_id", "source", "n_tokens", "ids", "same_text"]
