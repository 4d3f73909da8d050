"""SentencePiece encoding by an Aho-Corasick automaton and a single-pass Viterbi, and decoding.

The automaton reports, at every position of a text, all pieces that end there, the longest first, by following its output
links. Each of them relaxes the best score of that position from that of its own beginning, so one pass gives the
segmentation with the highest sum of scores. A character without a piece costs more than any piece and becomes its UTF-8
bytes. Ties go to the longest last piece.

Where no piece holds a space mark behind another character, a text falls apart before every run of spaces, and likewise
around line feeds when no piece holds one; the ids of such stretches are remembered. That changes no result.

Vocabularies of the BPE kind work too: their scores, the ranks of merges, are summed like those of a unigram model, so ids
can differ from those of merging, and decoding gives the same text.

A missing or empty text has no ids. Decoding gives back the text, whose space marks U+2581, if any, turn into spaces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.llm.common import list_values, slices

SPACE = "▁"
UNKNOWN_COST = 10
CACHE_STRETCHES = 1 << 19
CACHED_CHARS = 64
SLICE_BYTES = 1 << 20
IDS = np.dtype(np.int32)


class Pieces:
    """A vocabulary read from a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave texts as they are can be used")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.automaton, self.longer = (ahocorasick.Automaton(ahocorasick.STORE_INTS) for _ in range(2))
        self.sizes, self.scores = np.zeros(len(proto.pieces), np.int64), np.zeros(len(proto.pieces))
        self.bytes_of: list[bytes] = []
        self.byte_ids, singles, least = [0] * 256, set(), 0.0
        single_ids = np.full(0x110000, -1, np.int32)
        names = []
        for i, p in enumerate(proto.pieces):
            if p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.automaton.add_word(p.piece, i)
                self.sizes[i], self.scores[i] = len(p.piece), p.score
                self.bytes_of.append(p.piece.replace(SPACE, " ").encode())
                least = min(least, p.score)
                names.append(p.piece)
                if len(p.piece) == 1:
                    singles.add(p.piece)
                    single_ids[ord(p.piece)] = i
                else:
                    self.longer.add_word(p.piece, i)
            elif p.type == kinds.BYTE:
                byte = int(p.piece[3:5], 16)
                self.bytes_of.append(bytes([byte]))
                self.byte_ids[byte] = i
            else:
                self.bytes_of.append(b"")
        self.automaton.make_automaton()
        self.longer.make_automaton()
        self.single_ids = single_ids
        self.singles, self.unknown = singles, least - UNKNOWN_COST
        # No piece holds it, so none reaches across it.
        held = set().union(*names)
        self.barrier = next(c for c in map(chr, range(0x110000)) if c not in held)
        apart = not any(SPACE in n.lstrip(SPACE) for n in names)
        lines = not any("\n" in n for n in names)
        end = "\n" if lines else ""
        pattern = f"{SPACE}+[^{SPACE}{end}]*|[^{SPACE}{end}]+" if apart else f"[^{end}]+" if end else r"[\s\S]+"
        self.stretches = re.compile(pattern + ("|\n" if lines else ""))
        self.by_words = apart and lines
        self.known: dict[str, bytes] = {}
        #: Those met again since there were many of them.
        self.again: set[str] = set()

    def cut(self, text: str) -> list[str]:
        """The stretches of a text, with its space marks and its first one."""
        if not text:
            return []
        if not self.by_words or "  " in text or text[0] == " " or SPACE in text:
            return self.stretches.findall(self.prefix + text.replace(" ", SPACE))
        # The same where no two spaces meet: a stretch for every word, and one for every line feed.
        out = []
        for k, line in enumerate(text.split("\n")):
            first, *words = line.split(" ")
            if k:
                out.append("\n")
            else:
                first = self.prefix + first
            if first:
                out.append(first)
            out += [SPACE + w for w in words]
        return out

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids of the best segmentation."""
        n = len(text)
        best, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        at = 0

        def close(upto: int, at: int) -> None:
            # All pieces that end before `upto` are in; a character without a piece of its own may stand alone.
            for k in range(at, upto):
                if text[k] not in self.singles and best[k] + self.unknown > best[k + 1]:
                    best[k + 1], back[k + 1] = best[k] + self.unknown, (k, -1)

        for last, number in self.automaton.iter(text):
            if last > at:
                close(last, at)
                at = last
            start = last + 1 - int(self.sizes[number])
            total = best[start] + float(self.scores[number])
            if total > best[last + 1] or total == best[last + 1] and start < back[last + 1][0]:
                best[last + 1], back[last + 1] = total, (start, number)
        close(n, at)
        out: list[int] = []
        while n:
            start, number = back[n]
            out.extend([number] if number >= 0 else [self.byte_ids[b] for b in reversed(text[start:n].encode())])
            n = start
        return tuple(reversed(out))

    def segment_all(self, parts: list[str]) -> list[bytes]:
        """`segment` of each text, as 32-bit numbers.

        Texts whose every character is a piece are run through the automaton as one, with barriers between them, and all of
        them advance a position at a time: the best way to a position is the best over the pieces that end there. Pieces of one
        character end everywhere and are read off a table.
        """
        plain = [p for p in parts if len(p) <= CACHED_CHARS and self.barrier not in p and self.singles.issuperset(p)]
        found = dict(zip(plain, self._side_by_side(plain), strict=True)) if plain else {}
        return [found[p] if p in found else array("i", self.segment(p)).tobytes() for p in parts]

    def _side_by_side(self, parts: list[str]) -> list[bytes]:
        lengths = np.array([len(p) for p in parts])
        starts = np.cumsum(lengths + 1) - lengths - 1
        text = self.barrier.join(parts)
        matches = np.fromiter(chain.from_iterable(self.longer.iter(text)), np.int64).reshape(-1, 2)
        single = self.single_ids[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        alone = np.flatnonzero(single >= 0)
        end, number = np.concatenate([matches[:, 0], alone]) + 1, np.concatenate([matches[:, 1], single[alone]])
        place = end - np.repeat(starts, lengths + 1)[end - 1]
        # By position within their texts; the pieces that end at one place stay together, the longest first.
        order = np.argsort((place << 48) + (end << 8) - self.sizes[number])
        end, number, place = end[order], number[order], place[order]
        start, score = end - self.sizes[number], self.scores[number]
        best, back = np.zeros(len(text) + 1), np.zeros(len(text) + 1, np.int64)
        bounds = np.searchsorted(place, np.arange(1, int(lengths.max()) + 2))
        for low, high in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            total, here = best[start[low:high]] + score[low:high], end[low:high]
            first = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
            most = np.maximum.reduceat(total, first)
            equal = total == np.repeat(most, np.diff(np.append(first, len(total))))
            chosen = np.minimum.reduceat(np.where(equal, np.arange(len(total)), len(total)), first)
            best[here[first]], back[here[first]] = most, number[low:high][chosen]
        # All texts go back from their ends together, a piece at a time.
        owners, pieces, at, left = [], [], starts + lengths, np.arange(len(parts))
        while len(left):
            piece = back[at[left]]
            owners.append(left)
            pieces.append(piece)
            at[left] -= self.sizes[piece]
            left = left[at[left] > starts[left]]
        owner = np.concatenate(owners[::-1])
        ids = np.concatenate(pieces[::-1])[np.argsort(owner, kind="stable")].astype(IDS).tobytes()
        cut = np.append(0, np.cumsum(np.bincount(owner, minlength=len(parts))) * IDS.itemsize).tolist()
        return [ids[i:j] for i, j in zip(cut, cut[1:], strict=False)]

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return np.frombuffer(self.encode_all([text])[0], IDS).tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers; what is new among their stretches is segmented once."""
        cut = [self.cut(t) for t in texts]
        known, distinct = self.known, set(chain.from_iterable(cut))
        new = distinct.difference(known)
        if len(known) > CACHE_STRETCHES // 2:
            self.again |= distinct - new
        fresh = list(new)
        known.update(zip(fresh, self.segment_all(fresh), strict=True))
        out = [b"".join(map(known.__getitem__, parts)) for parts in cut]
        for p in new:
            if len(p) > CACHED_CHARS:
                del known[p]
        if len(known) > CACHE_STRETCHES:
            # Most stretches never come again; those that did stay, if need be the younger ones of them.
            kept = [p for p in known if p in self.again][-CACHE_STRETCHES // 2 :]
            self.known, self.again = {p: known[p] for p in kept}, set()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


#: What each worker process has read, by file; kept from task to task.
_READ: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _READ:
        _READ[path] = Pieces(path)
    return _READ[path]


def _encoder(path: str) -> Callable:
    def encode(texts: pa.Array) -> pa.Array:
        model, out = pieces(path), []
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        for part in slices(batch, "text", SLICE_BYTES):
            ids = model.encode_all(pc.fill_null(part.column("text"), "").to_pylist())
            ends = np.cumsum([0, *map(len, ids)]) // IDS.itemsize
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), IDS))))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    return encode


def _decoder(path: str) -> Callable:
    def decode(ids: pa.Array) -> pa.Array:
        model = pieces(path)
        ids = pc.fill_null(ids, pa.scalar([], ids.type))
        offsets, values = list_values(ids)
        out = []
        for lo, hi in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
            out.append(model.decode(values[lo:hi].tolist()))
        return pa.array(out, pa.string())

    return decode


def encode(text: Column, model_path: str) -> Column:
    """Ids of `text` as array<int>."""
    return F.arrow_udf(_encoder(model_path), "array<int>")(text)


def decode(ids: Column, model_path: str) -> Column:
    """The text of `ids`; missing ids give an empty text."""
    return F.arrow_udf(_decoder(model_path), "string")(ids)
