"""Spelling variants: words that differ by one inserted, deleted or replaced letter, and the form each most likely means.

The near words of a vocabulary come from a bit-sliced position index. For a block of words it holds one bitset per position and
letter: which words have that letter there. For a query of `size` letters, recurrences over the positions keep, a machine
word of candidates at a time, the candidates without an error so far and those with one, in the same step. A candidate leaves the first
set at its first differing letter and enters the second; there it goes on at the same position (a replaced letter) or at the next one (a
letter more). Looking from the shorter word alone finds every pair.

No block holds more than a bounded part of the vocabulary. The place where two words first differ lies in one of two halves of
the shorter one; outside of that half, words agree letter by letter. Words of `size` and `size` + 1 letters are therefore grouped by what
they hold outside of a window [low, high), and a pair counts in the one group whose window holds its place. A group with too
many letters in its window is split into two with half the window each, until none is left; a window of one place bounds a group
by the alphabet. Nothing is left out and no group is paired off.

Every block passes on one row per word, the number of its near words and the best of them. Forms point to words at least
`ratio` times as frequent, so following them ends; roots come from doubling the pointers.

Missing texts have no words, a missing doc_id counts as an empty one, repeated rows count as often as they occur, and an
empty vocabulary gives an empty result. Words of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import lower_ascii
from wattline.session import materialize

#: Letters that make up words: A to Z in either case, and the Latin-1 letters with the two signs between them.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A group with more letters than this in its window is split, and a block ends at so many words.
GROUP_LETTERS = 1 << 14
BLOCK = 2048
GROUP = ["size", "low", "high", "outer"]


def runs(docs: DataFrame, least: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): every longest run of letters with at least `least` of them, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col(text), F.lit(LETTERS + "{%d,}" % least), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run")).select(
        "doc_id", lower_ascii(F.col("run")).alias("run")
    )


def with_slips(doc_id: Column, run: Column, every: int) -> Column:
    """`run` without one letter wherever the crc32 of doc_id, a colon and the run is divided by `every`; it names the letter."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    crc = F.crc32(key.cast("binary"))
    place = (crc % F.length(run)).cast("int")
    return F.when(crc % every == 0, F.concat(run.substr(F.lit(1), place), run.substr(place + 2, F.length(run)))).otherwise(run)


def vocabulary(words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words long and frequent enough in the one column `word`."""
    counts = words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _windowed(df: DataFrame, windows: Column) -> DataFrame:
    """A row per window (size, low, high) of `windows`, with what the word holds outside of it."""
    word, size, low, high = (F.col(c) for c in ("word", "size", "low", "high"))
    behind = F.greatest(size - high, F.lit(0))
    outer = F.concat(word.substr(F.lit(1), low), F.right(word, behind))
    rows = df.select("word", "n", F.inline(windows))
    return rows.select("size", "low", "high", outer.alias("outer"), "word", "n")


def _window(size: Column, low: Column, high: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), low.cast("int").alias("low"), high.cast("int").alias("high"))


def _halves(size: Column, low: Column, high: Column) -> list[Column]:
    middle = F.floor((low + high) / 2)
    return [_window(size, low, middle), _window(size, middle, high)]


def groups(words: DataFrame) -> DataFrame:
    """(size, low, high, outer, word, n): the words of every group, none with too many letters in its window."""
    length = F.length("word")
    every = [w for size in (length, length - 1) for w in _halves(size, F.lit(0), size + 1)]
    rows, done = _windowed(words, F.filter(F.array(*every), lambda w: w["size"] > 0)), None
    while True:
        wide = F.col("high") - F.col("low")
        large = rows.groupBy(GROUP).agg(F.count("*").alias("many")).where((wide > 1) & (F.col("many") > 1) & (F.col("many") * wide > GROUP_LETTERS))
        large = materialize(large.drop("many"), "large-groups")
        small = rows.join(large, GROUP, "left_anti")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            return done
        split = rows.join(large, GROUP, "left_semi").withColumnsRenamed({c: f"old_{c}" for c in GROUP})
        halves = F.array(*_halves(*(F.col(f"old_{c}") for c in GROUP[:3])))
        rows = materialize(_windowed(split, halves), "split-groups")


class PositionIndex:
    """Bitsets over the words of a block: which have a given letter at a given place of the window."""

    def __init__(self, words: list[str], low: int, high: int):
        self.low, self.high, self.words = low, high, len(words)
        width = high + 1 - low
        # Places behind the last letter hold 0, which no query asks for.
        inner = "".join(w[low : high + 1].ljust(width, "\0") for w in words)
        codes = np.frombuffer(inner.encode("utf-32-le"), "<u4").reshape(len(words), width)
        letters, numbers = np.unique(codes, return_inverse=True)
        self.numbers = numbers.reshape(codes.shape)
        has = np.zeros((width, len(letters), -(-len(words) // 64) * 64), bool)
        place, word = np.meshgrid(np.arange(width), np.arange(len(words)), indexing="ij")
        has[place, self.numbers.T, word] = True
        self.planes = np.packbits(has, axis=2, bitorder="little").view(np.uint64)

    def bits(self, members: np.ndarray) -> np.ndarray:
        """Rows of booleans over the words as bitsets."""
        out = np.zeros((*members.shape[:-1], self.planes.shape[2] * 64), bool)
        out[..., : self.words] = members
        return np.packbits(out, axis=-1, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray, among: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitsets of the words that replace one letter of each query of `size` letters, and of those with one more.

        `among` are the words to look at for each query; outside of the window they agree with it.
        """
        same, replaced, longer = among.copy(), np.zeros_like(among), np.zeros_like(among)
        for k, at in enumerate(range(self.low, self.high)):
            if at == size:
                longer |= same
                break
            letter = self.numbers[queries, k]
            here = self.planes[k][letter]
            differ = same & ~here
            replaced = replaced & here | differ
            longer = (longer | differ) & self.planes[k + 1][letter]
            same &= here
        return replaced, longer


def _ones(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the bits set in rows of bitsets."""
    row, part = np.nonzero(rows)
    bits = np.unpackbits(rows[row, part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    one, bit = np.nonzero(bits)
    return row[one], part[one] * 64 + bit


def near_in_block(words: list[str], owner: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Ordered pairs of places in `words`, both ways, that differ by one letter first met in the window; `owner` numbers the groups."""
    length = np.array([len(w) for w in words])
    queries = np.flatnonzero(length == size)
    index = PositionIndex(words, low, high)
    members = index.bits(owner == np.arange(owner[-1] + 1)[:, None])
    replaced, longer = index.near(queries, members[owner[queries]], size)
    a, b = _ones(replaced & index.bits(length == size))
    c, d = _ones(longer & index.bits(length == size + 1))
    a, c = queries[a], queries[c]
    return np.concatenate([a, c, d]), np.concatenate([b, d, c])


def _best(words: list[str], counts: np.ndarray, owner: np.ndarray, size: int, low: int, high: int) -> list[tuple]:
    """(word, number of near words, largest count among them, the near word with it) of the words that have any."""
    one, other = near_in_block(words, owner, size, low, high)
    linked = np.unique(one)
    order = sorted(linked.tolist(), key=lambda i: (-counts[i], words[i]))
    rank = np.full(len(words), len(words))
    rank[order] = np.arange(len(order))
    best, many = np.full(len(words), len(words)), np.bincount(one, minlength=len(words))
    np.minimum.at(best, one, rank[other])
    return [(words[i], int(many[i]), int(counts[(form := order[best[i]])]), words[form]) for i in linked.tolist()]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(size, low, high, groups of (word, n)) with whole groups of one window, up to BLOCK words or one group."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in (*GROUP, "word", "n")), strict=True)

    for window, of_window in groupby(rows(), lambda r: r[:3]):
        held, many = [], 0
        for _, group in groupby(of_window, lambda r: r[3]):
            group = [r[4:] for r in group]
            if len(group) > 1 and any(len(w) == window[0] for w, _ in group):
                if many and many + len(group) > BLOCK:
                    yield *window, held
                    held, many = [], 0
                held.append(group)
                many += len(group)
        if held:
            yield *window, held


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for size, low, high, held in _blocks(batches):
        words = [w for group in held for w, _ in group]
        counts = np.array([n for group in held for _, n in group], np.int64)
        owner = np.repeat(np.arange(len(held)), [len(group) for group in held])
        found = _best(words, counts, owner, size, low, high)
        if found:
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def best_near(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word of `words` (word, n) with near words; ties to the smallest in code-point order."""
    sorted_groups = groups(words).repartition(*GROUP).sortWithinPartitions(*GROUP, "word")
    found = sorted_groups.mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    every = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("found"))
    return every.select("word", "n_near", (-F.col("found.less")).alias("best_n"), F.col("found.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of `forms` (word, form), which must not lead in circles: the last form that can be reached."""
    here = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = here.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = here.join(ahead, "root", "left")
        here = materialize(
            step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots"
        )
        if here.where("moved").isEmpty():
            return here.select("word", "root")
        here = here.select("word", "root")


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of the stored vocabulary `words` (word, n)."""
    near = words.join(best_near(words), "word", "left")
    is_form = F.col("best_n") >= F.col("n") * ratio
    named = materialize(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(named.where("form is not null"))
    full = named.join(last, "word", "left")
    return full.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
