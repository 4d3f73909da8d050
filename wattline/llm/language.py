"""Language by rank-order profiles of n-grams.

A text is lower-cased letter by letter; everything but letters and the marks on them is a gap between words. Its n-grams are
single letters, and pairs and triples of letters, which may begin or end at a gap. The profile of a language is the list of its
`size` most frequent n-grams in all texts it is learned from, the document's profile the same list of the document. They are
compared by out-of-place distance: for each n-gram of the document how far its place is from its place in the language's
list, or `size` where the language's list lacks it. The language at the least distance is the answer; its score is one less the
distance over the largest possible one.

Counts are of all learned texts, combined within tasks before they are shuffled. Only the profiles come to the driver, `size`
rows a language, and a column with more than MAX_LANGUAGES values is refused.

A missing text, one without a letter, and any text where no language was learned is `und` with score 0. Rows without a
language are not learned from. Equally frequent n-grams stand in the order of their code points, shorter ones last, and of
languages at equal distance the smallest name wins. Repeated rows count, and are answered, as often as they occur.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import slices

SIZE = 600
MAX_LANGUAGES = 8192
UNKNOWN = "und"
SLICE_BYTES = 1 << 20
#: N-grams that begin within so many letters are counted at once, and so many counted ones are held before they are passed on.
STRETCH = 1 << 20
HELD = 1 << 20
#: Stands in the place of letters that a shorter n-gram does not have; beyond the last code point.
_SHORT = (1 << 21) - 1

#: What each worker process has worked out once: the letter every code point counts as, 0 for a gap.
_LETTERS: list[np.ndarray] = []

Counts = tuple[np.ndarray, np.ndarray]


def _letters() -> np.ndarray:
    if not _LETTERS:
        known = np.zeros(sys.maxunicode + 1, np.int64)
        for code in range(sys.maxunicode + 1):
            kind = unicodedata.category(char := chr(code))[0]
            if kind in "LM":
                low = char.lower()
                # Marks are kept as negative numbers until it is known whether a text has any letter.
                known[code] = ord(low) if kind == "L" and len(low) == 1 else code if kind == "L" else -code
        _LETTERS.append(known)
    return _LETTERS[0]


def letters(text: str) -> np.ndarray:
    """Lower-cased letters of a text with one 0 before, between and behind its words; empty if it has no letter."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    if not (codes > 0).any():
        return codes[:0]
    codes = np.concatenate([[0], np.abs(codes), [0]])
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def merged(parts: list[Counts]) -> Counts:
    """Distinct n-grams in ascending order and their counts added up."""
    if len(parts) == 1:
        return parts[0]
    grams, places = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(places, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


def counted(codes: np.ndarray) -> Counts:
    """Distinct n-grams of `letters` in ascending order, and how often each occurs."""
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for start in range(0, len(codes), STRETCH):
        first = codes[start : start + STRETCH]
        second, third = codes[start + 1 : start + 1 + STRETCH], codes[start + 2 : start + 2 + STRETCH]
        one = first[first > 0] | _SHORT << 42 | _SHORT << 21
        two = (first[: len(second)] << 21 | second | _SHORT << 42)[(first[: len(second)] > 0) | (second > 0)]
        three = (first[: len(third)] << 42 | second[: len(third)] << 21 | third)[second[: len(third)] > 0]
        parts.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
    return merged(parts[1:] or parts)


def profile(counts: Counts, size: int) -> np.ndarray:
    """The most frequent n-grams, the most frequent first."""
    grams, times = counts
    return grams[np.argsort(-times, kind="stable")[:size]]


@dataclass
class Model:
    """Profiles side by side: `grams` in ascending order, and for each the languages that list it and its places there."""

    languages: list[str]
    size: int
    grams: np.ndarray
    starts: np.ndarray
    language: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, profiles: dict[str, list[int]], size: int) -> Model:
        names = sorted(profiles)
        every = np.array([g for name in names for g in profiles[name]], np.int64)
        language = np.repeat(np.arange(len(names)), [len(profiles[name]) for name in names])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(profiles[name])) for name in names)])
        order = np.argsort(every, kind="stable")
        grams, starts = np.unique(every[order], return_index=True)
        return cls(names, size, grams, np.append(starts, len(every)), language[order], place[order])

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a document's profile to that of each language."""
        out = np.full(len(self.languages), self.size * len(own), np.int64)
        if not len(self.grams):
            return out
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        listed = np.flatnonzero(self.grams[at] == own)
        first, many = self.starts[at[listed]], self.starts[at[listed] + 1] - self.starts[at[listed]]
        entries = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        off = np.abs(self.place[entries] - np.repeat(listed, many)) - self.size
        return out + np.bincount(self.language[entries], off, len(out)).astype(np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a text and its score."""
        own = profile(counted(letters(text)), self.size) if text and self.languages else ()
        if not len(own):
            return UNKNOWN, 0.0
        distances = self.distances(own)
        best = int(distances.argmin())
        return self.languages[best], 1 - float(distances[best]) / (self.size * len(own))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[Counts]] = defaultdict(list)

    def combined() -> int:
        for name, parts in held.items():
            held[name] = [merged(parts)]
        return sum(len(parts[0][0]) for parts in held.values())

    def rows() -> Iterator[pa.RecordBatch]:
        for name, ((grams, times),) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams)), pa.array(grams), pa.array(times)], ["lang", "gram", "n"]
            )
        held.clear()

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            texts = defaultdict(list)
            for name, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                texts[name].append(text)
            for name, own in texts.items():
                # A gap between two texts is a gap between words.
                held[name].append(counted(letters("\n".join(own))))
            if combined() > HELD:
                yield from rows()
    combined()
    yield from rows()


def fit(labelled: DataFrame, size: int = SIZE, text: str = "text", lang: str = "lang") -> Model:
    """Profiles of all texts of `labelled` whose language is known."""
    known = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    totals = known.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = totals.withColumn("place", F.row_number().over(frequent)).where(F.col("place") <= size)
    found = ranked.select("lang", "gram", "place").limit(MAX_LANGUAGES * size + 1).collect()
    if len(found) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    profiles = defaultdict(list)
    for row in sorted(found, key=lambda r: r["place"]):
        profiles[row["lang"]].append(row["gram"])
    return Model.of(profiles, size)


def with_language(docs: DataFrame, model: Model, text: Column) -> Column:
    """(lang, score) of `text` as a column for `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        batch, found = pa.RecordBatch.from_arrays([texts], ["text"]), []
        for part in slices(batch, "text", SLICE_BYTES):
            found += [shared.value.predict(t) for t in pc.fill_null(part.column("text"), "").to_pylist()]
        columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
        return pa.StructArray.from_arrays(columns, ["lang", "score"])

    return F.arrow_udf(predict, "lang string, score double")(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is set aside for testing: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
