import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_frames import LONG, awkward, nothing
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from wattline.llm import pieces
from wattline.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PATH)


@pytest.fixture(scope="module")
def scores():
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    normal = sentencepiece_model_pb2.ModelProto.SentencePiece.NORMAL
    return {p.piece: (p.score, i) for i, p in enumerate(proto.pieces) if p.type == normal}


def plain(text, scores, byte_ids):
    """The best segmentation by trying every piece at every place; ties to the longest last piece."""
    text = "▁" + text.replace(" ", "▁") if text else ""
    unknown = min(s for s, _ in scores.values()) - 10
    best = [(0, ())] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            piece = text[start:end]
            if piece in scores:
                score, ids = scores[piece][0], (scores[piece][1],)
            elif end - start == 1:
                score, ids = unknown, tuple(byte_ids[b] for b in piece.encode())
            else:
                continue
            total = best[start][0] + score
            if best[end] is None or total > best[end][0]:
                best[end] = (total, best[start][1] + ids)
    return list(best[-1][1])


TEXTS = ["", " ", "a", "  two  spaces ", "line\nline\n\n", "tab\tand \x00 zero", "日本語 ☃ naïve \U0001f600", "The end. " * 3, "x" * 70, "     deep     indent"]


def test_viterbi_equals_trying_every_piece(model, scores, spark, small):
    draw = random.Random(6)
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(40).collect()]
    texts = TEXTS + [t[(k := draw.randrange(len(t))) : k + 150] for t in docs]
    for t in texts:
        assert model.encode(t) == plain(t, scores, model.byte_ids), t


def test_stretches_do_not_change_the_result(model):
    for t in TEXTS + ["some words, and\nmore of them  again"]:
        whole = model.prefix + t.replace(" ", pieces.SPACE) if t else ""
        assert model.encode(t) == list(model.segment(whole))


def test_words_and_pattern_cut_alike(model, spark, small):
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(60).collect()]
    for t in docs + TEXTS + ["a \nb", "a\n b", "\n", "\na", "a\n\n", "a b ", "▁a b", "\n \n"]:
        assert model.cut(t) == (model.stretches.findall(model.prefix + t.replace(" ", pieces.SPACE)) if t else [])


def test_side_by_side_equals_one_by_one(model, spark, small):
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(60).collect()]
    parts = list({p for t in docs + TEXTS if t for p in model.stretches.findall(model.prefix + t.replace(" ", pieces.SPACE))})
    assert len(parts) > 1000
    together = [np.frombuffer(b, np.int32).tolist() for b in model.segment_all(parts)]
    assert together == [list(model.segment(p)) for p in parts]
    assert model.segment_all([]) == []


def test_decoding_as_the_library_does(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for t in TEXTS:
        assert model.decode(model.encode(t)) == t
        ids = library.encode(t)
        assert model.decode(ids) == library.decode(ids) == t


def test_memory_is_bounded(monkeypatch, scores):
    monkeypatch.setattr(pieces, "CACHE_STRETCHES", 40)
    own = pieces.Pieces(PATH)
    for k in range(10):
        text = " ".join(f"w{k}x{i}" for i in range(30)) + " " + "y" * 100
        assert own.decode(own.encode(text)) == text
        assert len(own.known) <= 60


def test_query_and_awkward_rows(spark, small):
    rows = QUERIES["op6_sentence_pieces"](spark, small).collect()
    assert len(rows) == 200 and all(r.same_text for r in rows)
    for docs in (awkward(spark), nothing(spark)):
        coded = docs.withColumn("ids", pieces.encode(F.col("text"), PATH)).withColumn("back", pieces.decode(F.col("ids"), PATH))
        assert all(r.back == (r.text or "") for r in coded.collect())
    none = spark.createDataFrame([(None,)], "ids array<int>")
    assert none.select(pieces.decode(F.col("ids"), PATH)).first()[0] == ""
    assert pieces.pieces(PATH).decode(pieces.pieces(PATH).encode(LONG)) == LONG
