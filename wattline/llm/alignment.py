"""Alignment of two tokenizers' tokens by the places in the text where both end.

The ends of a tokenizer's tokens are counted in bytes and kept in a dictionary from end to index. The ends that stand in both
dictionaries, in ascending order, cut the two id lists into groups that cover the same bytes; within a group every token of one side is
linked with every token of the other.

A text begins with the space that one tokenizer is given and the other adds by itself. It falls apart into stretches that
begin with a single space between two visible characters; no token of either vocabulary reaches across such a place (`Aligner`
makes sure of it), so both end there, and the groups of the stretches side by side are those of the text. The groups of a
stretch are remembered, in each worker process, which changes no result.

How many documents hold an id pair linked is counted over all documents. Documents go to parts of bounded size; a part's distinct
pairs meet the counts in a join, and come back to the part's documents as one dictionary. So a pair travels once for each part and
not once for each document or link, and the counts themselves may grow beyond any one machine.

A missing or empty text, and one whose tokens do not spell the text, has no tokens: numbers are 0 and the digest is ''.
Repeated rows are documents of their own.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import slices, sorted_groups
from wattline.session import materialize

SPACE = "▁"
PART_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
CACHE_STRETCHES = 1 << 19
#: New stretches encoded at once.
TOGETHER = 4096
CACHED_CHARS = 64
#: A group with more links is counted by distinct ids.
LARGE = 64
NONE = np.zeros(0, np.int64)
#: White space in any library's sense, controls and format signs; a stretch begins at a space between two other characters.
_UNSEEN = r"\s\x00-\x20\x7f-\xa0\xad\u0600-\u0605\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"
_APART = re.compile(f"(?<=[^{_UNSEEN}]) (?=[^{_UNSEEN}])")
#: A token with this in it would reach across the beginning of a stretch.
_ACROSS = re.compile(f"(?<=[^{_UNSEEN}]) (?![{_UNSEEN}])")


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for their own code; the other bytes, in order, for the code points from 256 on.
    """
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = sorted(set(range(256)) - set(seen))
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


def cuts(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Tokens of a, and tokens of b, up to each place where tokens of both end, in ascending order."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = sorted(at_a.keys() & at_b.keys())
    return [at_a[end] for end in common], [at_b[end] for end in common]


def links(found: list[tuple[list[int], list[int]]], shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs, as a << shift | b in ascending order, and how many occurrences each has."""
    keys, times = [], []
    for a, b in found:
        if len(a) * len(b) > LARGE:
            # Equal ids of a long group are counted before they are paired.
            (x, nx), (y, ny) = (np.unique(np.array(s, np.int64), return_counts=True) for s in (a, b))
            keys += (x[:, None] << shift | y).ravel().tolist()
            times += (nx[:, None] * ny).ravel().tolist()
        else:
            keys += [x << shift | y for x in a for y in b]
            times += [1] * (len(a) * len(b))
    return added(np.array(keys, np.int64), np.array(times, np.int64))


def added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and their times added up."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first)


class Stretch(NamedTuple):
    """What a stretch of text adds to its document: `keys` are int64 pairs, `times` their occurrences if not one each."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    keys: bytes
    times: bytes


class Aligned(NamedTuple):
    """Tokens, groups and links of a document; pairs are int64 keys a << shift | b in ascending order."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    keys: np.ndarray
    times: np.ndarray


class Aligner:
    """A byte-level tokenizer file (a) and a SentencePiece model with byte fallback (b)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        signs = byte_signs()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        spelled = {i: bytes(signs[c] for c in token) for token, i in vocabulary.items() if all(c in signs for c in token)}
        self.bytes_a = [spelled.get(i, b"") for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        control = [self.b.is_control(i) or self.b.is_unknown(i) for i in range(len(pieces))]
        self.bytes_b = [
            b"" if c else bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, (p, c) in enumerate(zip(pieces, control, strict=True))
        ]
        self.shift = max(1, (len(pieces) - 1).bit_length())
        # With a token that reaches across, texts are taken whole.
        self.apart = not any(_ACROSS.search(t.decode("utf-8", "replace")) for t in (*self.bytes_a, *self.bytes_b))
        self.length_a, self.length_b = (np.array([len(t) for t in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(pieces)))]
        #: None for a stretch that its tokens do not spell.
        self.known: dict[str, Stretch | None] = {}
        #: Those met again since the others were last forgotten.
        self.again: set[str] = set()

    def stretches(self, text: str) -> list[str]:
        """The text without its first space, cut at spaces that begin a stretch; these are not in the result."""
        return _APART.split(text) if self.apart else [text]

    def _learn(self, parts: list[str]) -> bool:
        """Remembers stretches, encoded as one text; says no if its tokens do not spell it and end with the stretches."""
        line = " ".join(parts)
        a = np.array(self.a.encode_batch_fast([" " + line], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(line), np.int64)
        text = (" " + line).encode()
        for ids, tokens in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(map(tokens.__getitem__, ids.tolist())) != text:
                return False
        upto_a, upto_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        cut_a, cut_b = (np.array(c, np.int64) for c in cuts(upto_a.tolist(), upto_b.tolist()))
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        bounds = upto_a[cut_a - 1]
        last = np.searchsorted(bounds, ends)
        if (bounds[np.minimum(last, len(bounds) - 1)] != ends).any():
            return False
        a0, b0 = np.append(0, cut_a[:-1]), np.append(0, cut_b[:-1])
        nb = cut_b - b0
        # Links of long groups are counted by distinct ids, and apart.
        many = (cut_a - a0) * nb
        before = np.append(0, np.cumsum(np.where(many > LARGE, 0, many)))
        owner = np.repeat(np.arange(len(many)), np.diff(before))
        k = np.arange(before[-1]) - before[owner]
        keys = (a[a0[owner] + k // nb[owner]] << self.shift | b[b0[owner] + k % nb[owner]]).tobytes()
        names = self.names.__getitem__
        names_a, names_b = list(map(names, a.tolist())), list(map(names, b.tolist()))
        listed = [
            names_a[i] + "|" + names_b[j] if one == 1 else ",".join(names_a[i:k]) + "|" + ",".join(names_b[j:m])
            for i, j, k, m, one in zip(*(c.tolist() for c in (a0, b0, cut_a, cut_b, many)), strict=True)
        ]
        long, group = np.flatnonzero(many > LARGE).tolist(), 0
        at, place_a, place_b = (8 * before).tolist(), [0, *cut_a.tolist()], [0, *cut_b.tolist()]
        for part, end in zip(parts, (last + 1).tolist(), strict=True):
            own, times = keys[at[group] : at[end]], b""
            apart = [(a[a0[g] : cut_a[g]].tolist(), b[b0[g] : cut_b[g]].tolist()) for g in long if group <= g < end] if long else []
            if apart:
                plain = np.frombuffer(own, np.int64)
                pairs, n = (np.concatenate(c) for c in zip((plain, np.ones(len(plain), np.int64)), links(apart, self.shift), strict=True))
                own, times = pairs.tobytes(), n.tobytes()
            n_a, n_b = place_a[end] - place_a[group], place_b[end] - place_b[group]
            self.known[part] = Stretch(n_a, n_b, end - group, ";".join(listed[group:end]), own, times)
            group = end
        return True

    def learn(self, parts: list[str], together: int) -> None:
        """Remembers the ids of stretches that may be encoded side by side, `together` at a time."""
        for start in range(0, len(parts), together):
            block = parts[start : start + together]
            if not self._learn(block):
                for part in block:
                    if len(block) == 1 or not self._learn([part]):
                        self.known[part] = None

    def align(self, text: str | None) -> Aligned | None:
        """What the tokens of a text have in common; None without tokens."""
        (found,) = self.align_all([text])
        return found

    def align_all(self, texts: list[str | None]) -> list[Aligned | None]:
        """`align` for each text; what is new among them is encoded together."""
        known, cut = self.known, [self.stretches(t) if t else None for t in texts]
        distinct = {p for parts in cut if parts for p in parts}
        new = distinct.difference(known)
        self.again |= distinct - new
        # Only where a text begins or ends can a stretch begin or end in something unseen, which might join with a neighbour.
        edges = {p for parts in cut if parts for p in (parts[0], parts[-1])} & new
        self.learn(list(new - edges), TOGETHER)
        self.learn(list(edges), 1)
        out = [self._document([known[p] for p in parts]) if parts else None for parts in cut]
        for p in new:
            if len(p) > CACHED_CHARS:
                del known[p]
        if len(known) > CACHE_STRETCHES:
            # Most stretches never come again; those that did stay, if need be the younger ones of them.
            kept = [p for p in known if p in self.again][-CACHE_STRETCHES // 2 :]
            self.known, self.again = {p: known[p] for p in kept}, set()
        return out

    def _document(self, found: list[Stretch | None]) -> Aligned | None:
        """A document of stretches side by side."""
        if None in found:
            return None
        n_a, n_b, n_groups, listed, keys, times = zip(*found, strict=True)
        pairs = np.frombuffer(b"".join(keys), np.int64)
        if any(times):
            one = np.ones(1, np.int64).tobytes()
            many = [t or one * (len(k) // 8) for k, t in zip(keys, times, strict=True)]
            own = added(pairs, np.frombuffer(b"".join(many), np.int64))
        else:
            own = np.unique(pairs, return_counts=True)
        return Aligned(sum(n_a), sum(n_b), sum(n_groups), ";".join(listed), *own)


#: What each worker process has read and remembers, by files; kept from task to task.
_READ: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _READ:
        _READ[path_a, path_b] = Aligner(path_a, path_b)
    return _READ[path_a, path_b]


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few bytes each as the largest needs, behind that number of bytes."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


#: Rows of documents, and behind those of each part one row with the part's distinct pairs and how many documents hold each.
ALIGNED = (
    "part long, is_part boolean, doc_id long, n_a long, n_b long, n_groups long, groups string, keys binary, times binary"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _batch(rows: list[tuple], layout: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in layout.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields]
    )


def _aligned(path_a: str, path_b: str, digest: bool, part_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, size = aligner(path_a, path_b), TaskContext.get().partitionId() << 32, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summary() -> tuple:
            keys, documents = added(*(np.concatenate(c) for c in zip(*held, strict=True)))
            return part, True, None, 0, 0, 0, "", packed(keys), packed(documents)

        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                rows, texts = [], piece.column("text").to_pylist()
                for doc_id, text, found in zip(piece.column("doc_id").to_pylist(), texts, model.align_all(texts), strict=True):
                    if size and size + len(text or "") > part_bytes:
                        if held:
                            rows.append(summary())
                        held, part, size = [], part + 1, 0
                    size += len(text or "")
                    if found is None:
                        rows.append((part, False, doc_id, 0, 0, 0, "", packed(NONE), packed(NONE)))
                        continue
                    listed = hashlib.sha256(found.groups.encode()).hexdigest() if digest else found.groups
                    numbers = (found.n_a, found.n_b, found.n_groups)
                    rows.append((part, False, doc_id, *numbers, listed, packed(found.keys), packed(found.times)))
                    held.append((found.keys, np.ones(len(found.keys), np.int64)))
                held = [added(*(np.concatenate(c) for c in zip(*held, strict=True)))] if held else []
                yield _batch(rows, ALIGNED)
        if held:
            yield _batch([summary()], ALIGNED)

    return run


def _part_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, keys, times in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "times")), strict=True):
            keys = unpacked(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), part)), pa.array(keys), pa.array(unpacked(times))], ["part", "key", "n"]
            )


def aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool = False, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows of ALIGNED for `docs` (doc_id, text), to be stored; `groups` lists the groups' ids, or is the SHA-256 of that."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(_aligned(path_a, path_b, digest, part_bytes), ALIGNED)


def pair_counts(stored: DataFrame, shift: int) -> tuple[DataFrame, DataFrame]:
    """(part, key) of the parts of stored rows, and (key, n, is_best) of all pairs: how many documents hold each linked."""
    summaries = stored.where("is_part").select("part", "keys", "times")
    in_parts = summaries.mapInArrow(_part_pairs, "part long, key long, n long")
    totals = in_parts.groupBy("key").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("key", shift)))
    return in_parts.select("part", "key"), totals.select("key", "n", (F.col("n") == most).alias("is_best"))


def _dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in sorted_groups(batches, ["part"]):
        keys, n, best = (table.column(c).to_numpy() for c in ("key", "n", "is_best"))
        value = packed(n << 1 | best)
        yield _batch([(int(table.column("part")[0].as_py()), True, None, 0, 0, 0, "", packed(keys), value)], ALIGNED)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, keys, values = None, NONE, NONE
    for batch in batches:
        rows = []
        for part, is_part, *row, pairs, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs, times = unpacked(pairs), unpacked(times)
            if is_part:
                own, keys, values = part, pairs, times
                continue
            if len(pairs) and part != own:
                raise ValueError("documents without the counts of their pairs")
            value = values[np.searchsorted(keys, pairs)] if len(pairs) else NONE
            sums = (int(times.sum()), int(times[value & 1 == 1].sum()), int((times * (value >> 1)).sum()))
            rows.append((*row[:4], *sums, row[4]))
        yield _batch(rows, RESULT)


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, digest: bool = False, part_bytes: int = PART_BYTES
) -> DataFrame:
    """RESULT for every row of `docs` (doc_id, text).

    `n_links` counts links between token occurrences, `n_best` those whose pair is in as many documents as any pair of its id of
    the first tokenizer, and `count_sum` adds up the documents of all links.
    """
    stored = materialize(aligned(docs, path_a, path_b, digest, part_bytes), "aligned")
    in_parts, totals = pair_counts(stored, aligner(path_a, path_b).shift)
    met = in_parts.join(totals, "key").select("part", "key", "n", "is_best")
    dictionaries = met.repartition("part").sortWithinPartitions("part", "key").mapInArrow(_dictionaries, ALIGNED)
    every = stored.where("not is_part").unionByName(dictionaries)
    # Each part's dictionary goes ahead of its documents.
    return every.repartition("part").sortWithinPartitions("part", F.desc("is_part")).mapInArrow(_results, RESULT)
