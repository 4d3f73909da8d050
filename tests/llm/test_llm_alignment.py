import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_frames import LONG, awkward, documents, nothing
from tokenizers import Tokenizer

from wattline.llm import alignment
from wattline.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Whole texts through the libraries, groups by walking both lists of ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        signs = alignment.byte_signs()
        self.bytes_a = {i: bytes(signs.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}

    def piece(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        x, y = [self.bytes_a[i] for i in a], [self.piece(i) for i in b]
        if not b"".join(x) == (" " + text).encode() == b"".join(y):
            return None
        out, i, j = [], 0, 0
        while i < len(a):
            k, m, n, o = i + 1, j + 1, len(x[i]), len(y[j])
            while n != o:
                if n < o:
                    n, k = n + len(x[k]), k + 1
                else:
                    o, m = o + len(y[m]), m + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out

    def rows(self, docs):
        """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of (doc_id, text)."""
        found = [(i, self.groups(t)) for i, t in docs]
        links = [Counter((x, y) for a, b in g or () for x in a for y in b) for _, g in found]
        held = Counter(p for own in links for p in own)
        most = {}
        for (a, _), n in held.items():
            most[a] = max(most.get(a, 0), n)
        out = []
        for (i, g), own in zip(found, links):
            listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
            sums = (sum(own.values()), sum(n for p, n in own.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in own.items()))
            out.append((i, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), *sums, listed))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def model():
    return alignment.Aligner(*PATHS)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r))


TEXTS = [
    " ", "a", "  two  spaces ", "line\nline\n\n x", "tab\t and \x00 zero", "日本語 ☃ naïve \U0001f600 \U0001f600‍ x", "The end. " * 3,
    "x" * 300, "     deep     indent", "<|endoftext|> is text </s> <s> <0x0A>", "don't we've I'll 12 345", "a b   c", "a　 b   c",
    "mark ▁ in", "é ́x", "🏳️‍🌈🏳️‍🌈", "﻿bom", "a ​b", "١٢٣ عربي", "ﬁ ﬂ", "\r\n \r\n", "12\x1f 3\x85 4", "—  – ‘x’", "a­ b",
]


def test_every_text_equals_whole_texts_through_the_libraries(model, plain, spark, small):
    draw = random.Random(13)
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    parts = [t[(k := draw.randrange(len(t))) : k + draw.choice([20, 300])] for t in docs for _ in range(5)]
    for t in TEXTS + parts:
        found, wanted = model.align(t), plain.groups(t)
        if wanted is None:
            assert found is None, t
            continue
        assert found.groups == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in wanted), t
        assert (found.n_a, found.n_b) == (sum(len(a) for a, _ in wanted), sum(len(b) for _, b in wanted))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab .,'é☃\n\t ‍1▁\U0001f600中"), max_size=30))
def test_any_text(model, plain, text):
    found, wanted = model.align(text), plain.groups(text)
    listed = None if wanted is None else ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in wanted)
    assert (found and found.groups) == listed


def test_query_equals_plain_version(spark, small, plain):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if t else ""
    wanted = [(*r[:-1], digest(r[-1])) for r in plain.rows(docs)]
    assert ordered(QUERIES["op13_token_alignment"](spark, small).collect()) == ordered(wanted)


@pytest.mark.parametrize("part_bytes", [alignment.PART_BYTES, 40])
def test_awkward_rows_in_parts_of_any_size(spark, plain, part_bytes):
    docs = awkward(spark)
    rows = alignment.align_documents(docs, *PATHS, part_bytes=part_bytes).collect()
    assert ordered(rows) == ordered(plain.rows([(r.doc_id, r.text) for r in docs.collect()]))


def test_documents_without_tokens(spark):
    docs = documents(spark, [(1, "a ▁ mark", "a"), (2, "", "a"), (3, None, "a")])
    for part_bytes in (alignment.PART_BYTES, 1):
        rows = alignment.align_documents(docs, *PATHS, part_bytes=part_bytes).collect()
        assert ordered(rows) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    assert alignment.align_documents(nothing(spark), *PATHS).collect() == []


def test_long_groups_are_counted_by_distinct_ids(model, monkeypatch):
    found = [([1, 1, 2] * 5, [7, 8, 7] * 4), ([3], [9])]
    wanted = Counter((x << 4 | y) for a, b in found for x in a for y in b)
    for large in (0, 64, 1000):
        monkeypatch.setattr(alignment, "LARGE", large)
        keys, times = alignment.links(found, 4)
        assert dict(zip(keys.tolist(), times.tolist())) == wanted
    whole = alignment.Aligner(*PATHS)
    monkeypatch.setattr(alignment, "LARGE", 1)
    for t in TEXTS + [LONG[:500]]:
        a, b = whole.align(t), model.align(t)
        assert (a is None) == (b is None)
        if a:
            assert a[:4] == b[:4] and np.array_equal(a.keys, b.keys) and np.array_equal(a.times, b.times)


@given(st.lists(st.integers(1, 5), min_size=1), st.lists(st.integers(1, 5), min_size=1))
def test_cuts_are_the_common_ends(x, y):
    ends_a, ends_b = np.cumsum(x).tolist(), np.cumsum(y).tolist()
    found = alignment.cuts(ends_a, ends_b)
    common = sorted(set(ends_a) & set(ends_b))
    assert [[ends_a[i - 1] for i in found[0]], [ends_b[j - 1] for j in found[1]]] == [common, common]


@given(st.lists(st.integers(0, 1 << 40)))
def test_packed_numbers_come_back(values):
    assert alignment.unpacked(alignment.packed(np.array(values, np.int64))).tolist() == values


def test_memory_is_bounded(monkeypatch, plain):
    monkeypatch.setattr(alignment, "CACHE_STRETCHES", 40)
    own = alignment.Aligner(*PATHS)
    for k in range(6):
        text = " ".join(f"w{k}x{i}" for i in range(30)) + " " + "y" * 100
        assert own.align(text).n_a == sum(len(a) for a, _ in plain.groups(text))
        assert len(own.known) <= 60
