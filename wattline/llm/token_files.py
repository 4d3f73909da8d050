"""Token-id files: the ids of many documents in one array, with Elias-Fano document boundaries.

A range partitioning puts documents in ascending order of doc_id; each part is then encoded and written as it comes. A file holds, little-endian: the magic word; its place in the order of files, the number of documents
without an id, the smallest doc_id and the bytes per id; the boundaries; the doc_ids, less the smallest; the ids. It ends
in a line feed. An id takes two bytes where the vocabulary allows, else four. A boundary costs a few bits where a table of
offsets would take 64.

A missing text is empty and a document without text holds the end id alone. Documents without a doc_id come first.
Repeated rows are repeated in the files, those with equal doc_id in the order of their texts.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import byte_texts, slices, write_blobs
from wattline.llm.elias_fano import EliasFano
from wattline.session import new_path

MAGIC = b"EFTOKENS"
HEAD = struct.Struct("<8sqqqq")
FILE_BYTES = 8 << 20
PART_BYTES = 16 << 20
SLICE_BYTES = 2 << 20
CACHE_WORDS = 1 << 20
CACHED_CHARS = 64
#: Stretches that the library is given at once.
GROUP_WORDS = 128
#: Stretches whose ids are laid out at once, which bounds the memory a long document takes.
BLOCK_WORDS = 1 << 16

#: What each worker process remembers, by tokenizer file; kept from task to task.
_KNOWN: dict[str, dict[bytes, bytes]] = {}
#: Latin letters that stay one letter each when normalized and lower-cased.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _stretches(texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
    """The lower-cased stretches of all texts one after another, and for each text where its own end.

    A single full stop or comma behind a Latin letter is a token of its own and is cut off at the end of a stretch.
    """
    given = pa.array(texts, pa.binary()).view(pa.string())
    # Special tokens are written between <| and |> and must be met as they are.
    lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(given, "<|"), given, pc.ascii_lower(given)))
    words, ends = lists.flatten(), lists.offsets.to_numpy()[1:]
    _, bounds, chars = words.buffers()
    bounds = np.frombuffer(bounds, np.int32, len(words) + 1, 4 * words.offset)
    long = np.flatnonzero(np.diff(bounds) > 1)
    if not len(long):
        return words, ends
    last = bounds[long + 1] - 1
    codes = np.frombuffer(chars, np.uint8)
    behind = codes[last - 1]
    letter = (behind >= ord("a")) & (behind <= ord("z"))
    # U+00C0 to U+00FF but for the signs of multiplication and division
    letter |= (codes[last - 2] == 0xC3) & (behind >= 0x80) & (behind != 0x97) & (behind != 0xB7)
    cut = letter & ((codes[last] == ord(".")) | (codes[last] == ord(",")))
    bounds = np.insert(bounds, long[cut] + 1, last[cut])
    ends = ends + np.searchsorted(long[cut], ends)
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), chars), ends


class WordEncoder:
    """Encodes texts through a lower-casing tokenizer that drops white space, one stretch between spaces at a time.

    No token of such a tokenizer crosses a space, so a stretch gives the same ids anywhere. The ids of stretches are
    remembered, lower-cased and without the stop behind them; beyond CACHE_WORDS only the younger half of it is kept.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _KNOWN.setdefault(path, {})

    def _learn(self, new: list[bytes]) -> None:
        """Runs of letters are a word each to the library and go to it joined; the rest go as words of their own."""
        plain, rest = [], []
        for w in new:
            (plain if _LETTERS.fullmatch(w.decode()) else rest).append(w)
        for joined, words in ((True, plain), (False, rest)):
            for i in range(0, len(words), GROUP_WORDS):
                group = words[i : i + GROUP_WORDS]
                asked = b" ".join(group).decode() if joined else [w.decode() for w in group]
                found = self.tokenizer.encode(asked, is_pretokenized=not joined, add_special_tokens=False)
                sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(group))
                if joined and not (len(sizes) == len(group) and sizes.all()):
                    rest += group
                    continue
                ids = np.array(found.ids, self.kind).tobytes()
                ends = (np.cumsum(sizes) * self.kind.itemsize).tolist()
                self.known.update(zip(group, [ids[a:b] for a, b in pairwise([0, *ends])], strict=True))

    def __call__(self, texts: list[bytes], end: bytes) -> list[bytes]:
        known, width = self.known, self.kind.itemsize
        stretches, ends = _stretches(texts)
        coded = stretches.dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        new = [w for w in words if w not in known]
        self._learn(new)
        values = [*map(known.__getitem__, words), end]
        for w in new:
            if len(w) > CACHED_CHARS:
                del known[w]
        if len(known) > CACHE_WORDS:
            for w in list(islice(known, len(known) - CACHE_WORDS // 2)):
                del known[w]
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // width
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(values), self.kind)
        codes = np.insert(coded.indices.to_numpy(), ends, len(words))
        laid, counts = [], sizes[codes]
        for i in range(0, len(codes), BLOCK_WORDS):
            block, n = codes[i : i + BLOCK_WORDS], counts[i : i + BLOCK_WORDS]
            upto = np.cumsum(n)
            laid.append(ids[np.repeat(starts[block] - upto + n, n) + np.arange(upto[-1])].tobytes())
        data = memoryview(b"".join(laid))
        upto = np.cumsum(counts)[ends + np.arange(len(ends))] * width
        return [bytes(data[a:b]) for a, b in pairwise([0, *upto.tolist()])]


def pack(order: int, doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One file, without the final line feed. Documents without an id come first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([0, *map(len, ids)]) // width
    above = known.view(np.uint64) - np.uint64(least % 2**64)
    return b"".join(
        [
            HEAD.pack(MAGIC, order, len(doc_ids) - len(known), least, width),
            EliasFano.encode(ends).to_bytes(),
            EliasFano.encode(above).to_bytes(),
            *ids,
        ]
    )


def unpack(data: bytes) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """Place of the file, doc_ids, boundaries and the array of all ids."""
    magic, order, unnamed, least, width = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    ends, rest = EliasFano.from_bytes(memoryview(data)[HEAD.size :])
    above, rest = EliasFano.from_bytes(rest)
    bounds = ends.decode()
    ids = np.frombuffer(rest, "<u2" if width == 2 else "<u4", count=int(bounds[-1]))
    return order, [None] * unnamed + (above.decode() + least).tolist(), bounds, ids


def _files(path: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, partition, piece = WordEncoder(path), TaskContext.get().partitionId(), 0
        end, width = np.array([end_id], encoder.kind).tobytes(), encoder.kind.itemsize
        doc_ids, ids, size = [], [], 0

        def done() -> pa.RecordBatch:
            file = pack(partition << 32 | piece, doc_ids, ids, width)
            return pa.RecordBatch.from_arrays([pa.array([file], pa.binary())], ["file"])

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                encoded = encoder(byte_texts(part.column("text")), end)
                for d, x in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                    if ids and size + len(x) > FILE_BYTES:
                        yield done()
                        piece, doc_ids, ids, size = piece + 1, [], [], 0
                    doc_ids.append(d)
                    ids.append(x)
                    size += len(x)
        if ids:
            yield done()

    return run


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encodes `docs` and writes files of about FILE_BYTES, or one document, below `path`."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    order = F.col("doc_id").asc_nulls_first()
    parts = narrow.repartitionByRange(max(1, -(-size // PART_BYTES)), order).sortWithinPartitions(order, "text")
    write_blobs(parts.mapInArrow(_files(tokenizer_path, end_id), "file binary"), path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("content"):
            order, doc_ids, bounds, ids = unpack(data.as_py())
            wide, n = ids.astype("<u4"), len(doc_ids)
            values = pa.BinaryArray.from_buffers(
                pa.binary(), n, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(wide)]
            )
            columns = [[order] * n, doc_ids, bounds[:-1], np.diff(bounds)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), values], ["file", "doc_id", "place", "n_tokens", "ids"]
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, place, n_tokens, ids) of the files: `place` counts ids within the file, `ids` are uint32 bytes."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_documents, "file long, doc_id long, place long, n_tokens long, ids binary")


def with_starts(found: DataFrame) -> DataFrame:
    """`start`, the number of ids of all documents before, from stored rows of `read`; sums run over files."""
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    return found.join(bases, "file").withColumn("start", F.col("base") + F.col("place"))


def save(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> str:
    """Encodes `docs` and writes them; returns the folder."""
    path = path or new_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer_path, end_id)
    return path
