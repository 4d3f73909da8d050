"""Quality scores by a vote of the nearest labelled documents in a latent semantic space.

A word's features are the word itself, its trigrams of bytes, and the places where one kind of character follows another,
hashed into FEATURES buckets. Three more features count what repeats within a document: words equal to the one before, words
equal to the one before that, and how much a few words make up the whole. A document is the sum of its features times idf,
projected on the leading singular vectors of labelled documents.

The classifier is fitted on at most `max_labelled` labelled rows, drawn by a hash of doc_id; document frequencies are
counted over all documents. Their latent vectors, a megabyte, go to every task, which compares each of its documents with
all of them in blocks and lets the NEIGHBOURS most similar ones vote, weighted by similarity.

A missing or empty text, and any text without a similar neighbour, scores the share of good labels. Without any label
every score is 0.5. Rows without a label are not learned from; repeated labels count as often as they occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import byte_texts, slices
from wattline.llm.perfect_hash import mix64
from wattline.session import materialize

FEATURES = 2048
#: Features of repetition, after those of words, and their weight against a word's own.
REPEATS = 3
REPEAT_WEIGHT = 8
COLUMNS = FEATURES + REPEATS
RANK = 64
MAX_LABELLED = 4096
NEIGHBOURS = 15
POWER = 8
BLOCK = 256
SLICE_BYTES = 1 << 20
PAIRS = 1 << 17

_KINDS = np.zeros(256, np.uint8)
_KINDS[128:] = 1
for _first, _last, _kind in ((b"a", b"z", 1), (b"A", b"Z", 2), (b"0", b"9", 3)):
    _KINDS[_first[0] : _last[0] + 1] = _kind


def _bucket(codes: np.ndarray, salt: int) -> np.ndarray:
    return (mix64(codes.astype(np.uint64) + np.uint64(salt << 56)) % np.uint64(FEATURES)).astype(np.int64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' features one after the other, and where those of each word begin."""
    line = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    low = np.frombuffer(line.tobytes().lower(), np.uint8).astype(np.uint64)
    gap = line == 32
    owner = np.cumsum(gap) - 1
    # A trigram belongs to the word of its middle byte, a change of kind to the word on either side of it.
    middle = np.flatnonzero(~gap[1:-1]) + 1
    trigrams = low[middle - 1] << np.uint64(16) | low[middle] << np.uint64(8) | low[middle + 1]
    kinds = np.where(_KINDS[line] > 0, _KINDS[line] + 250, line).astype(np.uint64)
    turn = np.flatnonzero(kinds[1:] != kinds[:-1])
    whole = np.array([zlib.crc32(w.lower()) for w in words], np.uint64)
    owners = [np.arange(len(words)), owner[middle], owner[np.where(gap[turn + 1], turn, turn + 1)]]
    buckets = [_bucket(whole, 1), _bucket(trigrams, 2), _bucket(kinds[turn] << np.uint64(16) | kinds[turn + 1], 3)]
    of, found = np.concatenate(owners), np.concatenate(buckets)
    starts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(words)))])
    return found[np.argsort(of, kind="stable")], starts


def repeats(words: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The features of repetition of a document's word numbers; `times` are those of its distinct words."""
    near = [(words[k:] == words[:-k]).sum() for k in (1, 2)]
    return REPEAT_WEIGHT * np.array([*near, (times.astype(np.float64) ** 2).sum() / len(words)], np.float32)


def counts(texts: list[bytes]) -> np.ndarray:
    """The features of every text, a row each."""
    docs = [t.split() for t in texts]
    words = list(set().union(*docs))
    number = dict(zip(words, range(len(words)), strict=True))
    ends = np.cumsum([0, *map(len, docs)])
    out = np.zeros((len(texts), COLUMNS))
    if not words:
        return out.astype(np.float32)
    buckets, starts = word_features(words)
    at = np.concatenate([np.fromiter(map(number.__getitem__, d), np.int64, len(d)) for d in docs])
    keys, times = np.unique(np.repeat(np.arange(len(docs)) * len(words), np.diff(ends)) + at, return_counts=True)
    doc, word = np.divmod(keys, len(words))
    for lo in range(0, len(keys), PAIRS):
        some = slice(lo, lo + PAIRS)
        sizes = starts[word[some] + 1] - starts[word[some]]
        into = np.cumsum(sizes)
        places = np.repeat(starts[word[some]] - (into - sizes), sizes) + np.arange(into[-1])
        first, last = doc[some][0], doc[some][-1]
        cells = np.repeat((doc[some] - first) * COLUMNS, sizes) + buckets[places]
        added = np.bincount(cells, np.repeat(times[some], sizes), (last - first + 1) * COLUMNS)
        out[first : last + 1] += added.reshape(-1, COLUMNS)
    firsts = np.searchsorted(doc, np.arange(len(docs) + 1))
    for i in np.flatnonzero(np.diff(ends)):
        out[i, FEATURES:] = repeats(at[ends[i] : ends[i + 1]], times[firsts[i] : firsts[i + 1]])
    return out.astype(np.float32)


@dataclass
class Model:
    """`projection` takes features to the latent space, idf included; `neighbours` are unit vectors with `labels`."""

    projection: np.ndarray
    neighbours: np.ndarray
    labels: np.ndarray
    prior: float


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(COLUMNS, np.int64), 0
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            total += (counts(byte_texts(part.column("text"))) > 0).sum(axis=0)
            n += part.num_rows
    places = np.append(np.arange(COLUMNS), -1)
    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(total, n))], ["feature", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            rows = [r.tobytes() for r in counts(byte_texts(part.column("text")))]
            arrays = [part.column("doc_id"), part.column("label"), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "label", "counts"])


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _leading(x: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration."""
    basis = np.random.default_rng(0).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(x.dtype)
    for _ in range(4):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, inner = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ inner.T)[:, :rank]


def fit(
    docs: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED, rank: int = RANK, text: str = "text"
) -> Model:
    """Learns from `labelled` (doc_id, label 0 or 1), whose texts are those of `docs` with the same doc_id."""
    narrow = docs.select("doc_id", F.col(text).alias("text"))
    drawn = labelled.where("label is not null and doc_id is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    drawn = drawn.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "label").limit(max_labelled)
    drawn = materialize(drawn, "drawn-labels")
    examples = narrow.join(drawn, "doc_id").select("doc_id", "label", "text")
    # A repeated document would pass the bound.
    found = examples.mapInArrow(_examples, "doc_id long, label int, counts binary").orderBy("doc_id", "label", "counts")
    found = found.limit(max_labelled).collect()
    frequencies = narrow.select("text").mapInArrow(_frequencies, "feature long, n long")
    totals = {r["feature"]: r["n"] for r in frequencies.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    labels = np.array([r["label"] for r in found], np.float32)
    idf = np.log((1 + totals.get(-1, 0)) / (1 + np.array([totals.get(i, 0) for i in range(COLUMNS)]))).astype(np.float32) + 1
    if not len(labels):
        return Model(np.zeros((COLUMNS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    weighted = _unit(np.stack([np.frombuffer(bytes(r["counts"]), np.float32) for r in found]) * idf)
    basis = _leading(weighted, rank)
    return Model(idf[:, None] * basis, _unit(weighted @ basis), labels, float(labels.mean()))


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """The similarity-weighted vote of each text's nearest labelled vectors."""
    out, k = np.full(len(texts), model.prior), min(NEIGHBOURS, len(model.labels))
    if not k:
        return out
    vectors = _unit(counts(texts) @ model.projection)
    for start in range(0, len(texts), BLOCK):
        near = vectors[start : start + BLOCK] @ model.neighbours.T
        best = np.argpartition(near, len(model.labels) - k, axis=1)[:, len(model.labels) - k :]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** POWER
        vote = (weight * model.labels[best]).sum(axis=1) + 1e-9 * model.prior
        out[start : start + BLOCK] = vote / (weight.sum(axis=1) + 1e-9)
    return out


def with_score(docs: DataFrame, model: Model, text: Column) -> Column:
    """The score of `text` as a column for `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [scores(byte_texts(part.column("text")), shared.value) for part in slices(batch, "text", SLICE_BYTES)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return F.arrow_udf(score, "double")(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is set aside for testing: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, **options) -> Model:
    """Fits on the rows of `labels` (doc_id, quality) that are not held out."""
    return fit(docs, labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label")), **options)
