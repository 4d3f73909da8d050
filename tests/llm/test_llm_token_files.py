import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_frames import LONG, awkward, nothing
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

from wattline.llm import token_files
from wattline.llm.elias_fano import EliasFano
from wattline.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 9], [2**40, 2**40 + 1], list(range(0, 9000, 3))])
def test_elias_fano_round_trip(values):
    coded = EliasFano.encode(np.array(values, np.int64))
    again, rest = EliasFano.from_bytes(memoryview(coded.to_bytes() + b"rest"))
    assert bytes(rest) == b"rest"
    assert again.decode().tolist() == values
    assert [again.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    draw = random.Random(2)
    ends = np.cumsum([draw.randint(1, 2000) for _ in range(20_000)])
    assert len(EliasFano.encode(ends).to_bytes()) * 8 < 14 * len(ends)


def test_texts_as_the_library_encodes_them():
    encoder = token_files.WordEncoder(PATH)
    texts = [
        "Hello, World. It's o'clock... e.g. a.b, c., d!!, x.", "Ångström. İstanbul ΣΑΣ.\x1cb \xa0c d", "<|endoftext|> a<|ENDOFTEXT|>b.",
        "", " \n", "x" * 500 + ". y", "naïve, café. 日本語。 ☃, \U0001f600.", LONG[:5000],
    ]
    for t, b in zip(texts, encoder([t.encode() for t in texts], b""), strict=True):
        assert np.frombuffer(b, encoder.kind).tolist() == ids_of(t)[:-1], t


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_WORDS", 50)
    monkeypatch.setattr(token_files, "_KNOWN", {})
    encoder = token_files.WordEncoder(PATH)
    for k in range(20):
        text = " ".join(f"word{k * 7 + i}" for i in range(30))
        assert np.frombuffer(encoder([text.encode()], b"")[0], encoder.kind).tolist() == ids_of(text)[:-1]
        assert len(encoder.known) <= 80


class Counted:
    """A tokenizer that counts what it is asked to encode."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, 0

    def encode(self, text, **options):
        self.asked += 1
        return self.tokenizer.encode(text, **options)

    def encode_batch(self, texts, **options):
        self.asked += len(texts)
        return self.tokenizer.encode_batch(texts, **options)


class Counting(dict):
    looked_up = 0

    def __getitem__(self, word):
        self.looked_up += 1
        return super().__getitem__(word)


def test_new_words_go_to_the_library_together_and_known_ones_are_looked_up_once():
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdeéüœ", k=8)) for _ in range(5000)]
    text = " ".join(words + words[:10] * 2000)
    encoder = token_files.WordEncoder(PATH)
    encoder.known, encoder.tokenizer = Counting(), Counted(encoder.tokenizer)
    (found,) = encoder([text.encode()], b"")
    assert np.frombuffer(found, encoder.kind).tolist() == ids_of(text)[:-1]
    assert encoder.tokenizer.asked <= 50
    assert encoder.known.looked_up <= 5000


@pytest.mark.parametrize("group, block", [(1, 1), (3, 7), (1000, 1000)])
def test_groups_and_blocks_change_no_ids(monkeypatch, group, block):
    monkeypatch.setattr(token_files, "GROUP_WORDS", group)
    monkeypatch.setattr(token_files, "BLOCK_WORDS", block)
    monkeypatch.setattr(token_files, "_KNOWN", {})
    draw = random.Random(4)
    signs = "aabbcczÉéİıŉſΣσßǅﬁ日가각אכ×÷😀☃'’.,.,!-_09½\x00\x1c\x85\xa0\u2028\u3000\u0301\u0308\u0345 \n\t\r\x0b\x0c    "
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(300)]
    texts += ["", " ", ".", "a.", "a. ", " a,\tb.", "A. B, c", "<|endoftext|>. A. b,", "x<|startoftext|>y. <|ENDOFTEXT|>"]
    texts += ["it's. 'S, x..", "é.", "×. a÷, ÿ, bÀ. Ã.", "Ó. <|", "日. ã., е, \u0301."]
    encoder = token_files.WordEncoder(PATH)
    whole = encoder([t.encode() for t in texts], b"\2\0")
    plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(b, encoder.kind).tolist() for b in whole] == [[*e.ids, 2] for e in plain]


def test_tokenizer_that_cuts_words_of_letters(tmp_path):
    pieces = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Split(Regex("[aeiou]"), "isolated")])
    tokenizer = Tokenizer(models.WordLevel({"?": 0, "a": 1, "b": 2, "c": 3, "e": 4}, unk_token="?"))
    tokenizer.normalizer, tokenizer.pre_tokenizer = normalizers.Lowercase(), pieces
    tokenizer.save(path := str(tmp_path / "cuts.json"))
    text, encoder = "Bac a bb ceb. e, x 1a", token_files.WordEncoder(path)
    wanted = tokenizer.encode("bac a bb ceb . e , x 1a").ids
    assert np.frombuffer(encoder([text.encode()], b"")[0], encoder.kind).tolist() == wanted


def test_query_equals_plain_encoding(spark, small):
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    start, wanted = 0, []
    for d, text in docs:
        ids = ids_of(text)
        wanted.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op7_token_files"](spark, small).collect())) == wanted


def test_awkward_rows_over_many_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 2000)
    for docs in (awkward(spark), nothing(spark)):
        path = token_files.save(docs, PATH, 2)
        found = token_files.with_starts(token_files.read(spark, path).cache())
        rows = found.orderBy(F.col("start"), F.col("n_tokens")).collect()
        texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        assert [r.doc_id for r in rows] == [d for d, _ in texts]
        assert [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows] == [ids_of(t) for _, t in texts]
        assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
