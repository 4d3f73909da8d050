"""Secrets in texts: patterns, and windows of high entropy in candidate strings.

Three kinds follow patterns: values assigned to telling names, access keys and long hexadecimal strings. A fourth,
`entropy`, looks at candidate strings, longest runs of characters that keys are made of. A candidate belongs to a character
class, hexadecimal or base64, with its alphabet, window and least entropy. A window slides over it; the counts of the
alphabet's characters change by one that enters and one that leaves, and with them the sum of c * log2(c), kept in whole
millionths so that nothing drifts. Windows above the class's entropy that overlap form one span. Candidates on the allow
list, such as UUIDs and runs of letters only or of digits only, are passed over. In a candidate shaped like
a path or a joined name only windows that touch a part between separators with letters and digits count; within a
hexadecimal part the entropy of that class is enough. Windows that touch a placeholder word do not count, nor those that
touch the plain words and numbers joined to one; what stands behind or before these is looked at as usual.

All of it is DataFrame expressions. Places are code points, ends exclusive. A missing or empty text has no spans. Rows are
looked at one by one, so repeated rows give repeated results. A text or candidate of any length is taken whole, in time that grows with its
length: a candidate becomes an array of places in the alphabet once, what leaves a window is found by index, counts lie side by side in a few
whole numbers, long arrays are walked in blocks, and no pattern repeats a group.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed patterns: kind, pattern, and the least length of the group given.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: Shortest match of `hex` that counts is found at once; shorter runs, nearly every word, need not be listed.
_LISTED = {"hex": r"[0-9a-f]{24,}"}

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
)
#: Paths and joined names fall into parts at these. Their parts are of letters, the last one with digits or empty, or else all are short.
PATH_SEPARATOR = r"[/_-]"
PATH_PARTS = ((r"^[A-Za-z]+$", r"^[A-Za-z0-9]*$"), (r"^[A-Za-z0-9]{1,15}$", r"^[A-Za-z0-9]{0,15}$"))
SEPARATOR = r"[+/_=-]"
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "test", "xxxx", "1234567890", "abcdefgh")
#: A UUID as some parts of a candidate, and letters that stand for it when parts are looked at.
_UUID = r"(?<![A-Za-z0-9])" + ALLOWED[0][1:-1] + r"(?![A-Za-z0-9])"
_UUID_LETTERS = "aaaaaaaa-aaaa-aaaa-aaaa-aaaaaaaaaaaa"


class CharacterClass(NamedTuple):
    pattern: str
    alphabet: str
    bits: float


CLASSES = (
    CharacterClass(r"^[0-9a-fA-F]+$", "0123456789abcdefABCDEF", 2.9),
    CharacterClass(r".", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
)
MILLION = 1_000_000
#: c * log2(c) in millionths for every count a window can hold.
TERMS = [round(c * math.log2(c) * MILLION) if c else 0 for c in range(WINDOW + 1)]


def most_even(bits: float) -> int:
    """The largest sum of terms at which a window still has `bits` of entropy per character."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * MILLION)


#: Counts of a window lie in whole numbers of 60 bits, so many of them in each and so many bits for one.
PACKED, BITS = 12, 5
BLOCK = 1024


def _in_blocks(items: Column, size: Column) -> Column:
    """An array that is not empty as an array of arrays of `size`, the last one shorter."""
    starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int"))
    return F.transform(starts, lambda k: F.slice(items, k * size + 1, size))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.aggregate(F.array(F.lit(0)), value, lambda held, _: held, body)


def matches(text: Column, pattern: str) -> Column:
    """(start, end, text) of all leftmost matches that do not overlap.

    What stands between the matches comes from a split at the same pattern; adding up lengths gives the places. The state of an
    aggregate is copied at every step, so matches are added up in blocks of about the square root of their number.
    """
    parts = F.filter(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")),
        lambda p: p["match"].isNotNull(),
    )
    one = "struct<start:int,end:int,text:string>"
    none, empty = F.array().cast(f"array<{one}>"), F.array().cast(f"array<array<{one}>>")

    def step(seen: Column, part: Column) -> Column:
        start = seen["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        found = F.struct(start.alias("start"), end.alias("end"), part["match"].alias("text"))
        return F.struct(end.alias("at"), F.array_append(seen["found"], found).alias("found"))

    def block(seen: Column, items: Column) -> Column:
        own = F.aggregate(items, F.struct(seen["at"].alias("at"), none.alias("found")), step)
        return _let(own, lambda o: F.struct(o["at"].alias("at"), F.array_append(seen["found"], o["found"]).alias("found")))

    def walked(items: Column) -> Column:
        blocks = _in_blocks(items, F.greatest(F.lit(1), F.sqrt(F.size(items)).cast("int")))
        start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
        return F.aggregate(blocks, start, block, lambda walk: F.flatten(walk["found"]))

    return F.when(text.rlike(pattern), _let(parts, walked)).otherwise(none)


def base_spans(text: Column, number: int) -> Column:
    """(start, number, end) of the matches of a base kind that are long enough."""
    kind, pattern, group, least = BASE[number]
    kept = F.filter(
        matches(text, _LISTED.get(kind, pattern)),
        lambda m: F.length(F.regexp_extract(m["text"], pattern, group)) >= least,
    )
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))


def _any(text: Column, patterns: tuple[str, ...]) -> Column:
    first, *more = [text.rlike(pattern) for pattern in patterns]
    for one in more:
        first = first | one
    return first


def _is_path(text: Column) -> Column:
    """Whether a candidate is shaped like a path or a joined name."""
    parts = F.split(text, PATH_SEPARATOR, -1)
    first, last = F.slice(parts, 1, F.size(parts) - 1), F.element_at(parts, -1)

    def shaped(of: str, end: str) -> Column:
        return F.forall(first, lambda p: p.rlike(of)) & last.rlike(end)

    return (F.size(parts) > 1) & (shaped(*PATH_PARTS[0]) | shaped(*PATH_PARTS[1]))


def _mask(text: Column) -> Column:
    """A sign for each character of a candidate.

    `#`, or `h` in hexadecimal parts, stands in what makes a window count, `!` in what keeps it from counting, `.` elsewhere.
    """

    def sign(part: Column) -> Column:
        mixed = part.rlike("[0-9]") & part.rlike("[A-Za-z]")
        return F.when(mixed & part.rlike(CLASSES[0].pattern), "h").when(mixed, "#").otherwise(".")

    marked = F.regexp_replace(text, _UUID, _UUID_LETTERS)
    for word in PLACEHOLDERS:
        marked = F.regexp_replace(marked, f"(?i){word}", "!" * len(word))
    mask = F.array_join(F.transform(F.split(marked, SEPARATOR, -1), lambda p: F.regexp_replace(p, "[^!]", sign(p))), ".")
    # A placeholder takes along the plain parts around it, up to the next part with letters and digits.
    runs = F.regexp_extract_all(mask, F.lit("[.!]+|[^.!]+"), F.lit(0))
    mask = F.array_join(F.transform(runs, lambda r: F.when(F.contains(r, F.lit("!")), F.translate(r, ".", "!")).otherwise(r)), "")
    return F.when(_is_path(text), mask).otherwise(F.translate(mask, ".h", "##"))


def _even_windows(text: Column, mask: Column, kind: CharacterClass) -> Column:
    """(start, end) within `text`, a string over the class's alphabet, of stretches covered by windows of high entropy."""
    limit = most_even(kind.bits)
    # What the c-th occurrence of a character adds to the sum of terms.
    gains = F.array(*[F.lit(b - a).cast("long") for a, b in zip(TERMS, [*TERMS[1:], TERMS[-1]], strict=True)])
    # A character is its place in the alphabet times four, and its sign.
    place = lambda c, sign: (F.position(c, F.lit(kind.alphabet)) - 1) * 4 + F.position(sign, F.lit("#h!"))
    # Splitting at nothing would look for each character from the beginning.
    characters = lambda t: F.regexp_extract_all(t, F.lit("."), F.lit(0))
    codes = F.zip_with(characters(text), characters(mask), place)
    none = F.array().cast("array<struct<start:int,end:int>>")

    def digit(code: Column) -> tuple[Column, Column]:
        """The number that counts a character, and where in it."""
        at = F.call_function("shiftright", code, F.lit(2))
        return F.floor(at / PACKED).cast("int"), (at % PACKED * BITS).cast("int")

    def count(packed: Column, code: Column) -> Column:
        number, bit = digit(code)
        own = F.call_function("shiftright", F.element_at(packed, number + 1), bit)
        return own.bitwiseAND(F.lit((1 << BITS) - 1).cast("long")).cast("int")

    def moved(packed: Column, code: Column, by: Column) -> Column:
        number, bit = digit(code)
        one = F.struct(number.alias("number"), F.call_function("shiftleft", by, bit).alias("by"))
        return _let(one, lambda o: F.transform(packed, lambda n, k: F.when(k == o["number"], n + o["by"]).otherwise(n)))

    def walked(codes: Column) -> Column:
        """All stretches; the codes stay outside of the state, which is copied at every step."""

        def slide(seen: Column, i: Column) -> Column:
            """What enters the window that ends at place `i` and what leaves it, the counts without the latter, and the sum it takes along."""
            old = F.when(i > WINDOW, F.element_at(codes, F.greatest(i - WINDOW, F.lit(1))))
            both = F.struct(F.element_at(codes, i).alias("new"), old.alias("old"))

            def without(c: Column) -> Column:
                first = c["old"].isNull()
                left = F.when(first, seen["counts"]).otherwise(moved(seen["counts"], c["old"], F.lit(-1).cast("long")))
                lost = F.when(first, F.lit(0).cast("long")).otherwise(F.element_at(gains, count(seen["counts"], c["old"])))
                return F.struct(c["new"].alias("new"), c["old"].alias("old"), left.alias("counts"), lost.alias("lost"))

            return _let(both, without)

        def step(seen: Column, i: Column) -> Column:
            def enter(c: Column) -> Column:
                # The sign of what enters and of what leaves moves the number of each sign in the window.
                signs = [
                    (seen[name] + F.when(c["new"] % 4 == k, 1).otherwise(0) - F.when(c["old"] % 4 == k, 1).otherwise(0)).alias(name)
                    for k, name in enumerate(("marked", "hexes", "barred"), 1)
                ]
                total = seen["total"] - c["lost"] + F.element_at(gains, count(c["counts"], c["new"]) + 1)
                counts = moved(c["counts"], c["new"], F.lit(1).cast("long"))
                return F.struct(counts.alias("counts"), total.alias("total"), *signs)

            def decide(w: Column) -> Column:
                enough = ((w["total"] <= limit) & (w["marked"] + w["hexes"] > 0)) | (w["hexes"] == WINDOW)
                hit = (i >= WINDOW) & (w["total"] <= most_even(CLASSES[0].bits)) & enough & (w["barred"] == 0)
                # The last stretch stays open until a window begins behind its end.
                last, start = seen["last"], i - WINDOW
                joins = (last["end"] > 0) & (last["end"] >= start)
                grown = F.struct(F.when(joins, last["start"]).otherwise(start).alias("start"), i.alias("end"))
                closes = hit & (last["end"] > 0) & (last["end"] < start)
                return F.struct(
                    *[w[name].alias(name) for name in ("counts", "total", "marked", "hexes", "barred")],
                    F.when(hit, grown).otherwise(last).alias("last"),
                    F.when(closes, F.array_append(seen["spans"], last)).otherwise(seen["spans"]).alias("spans"),
                )

            return _let(_let(slide(seen, i), enter), decide)

        kept = ("counts", "total", "marked", "hexes", "barred", "last")

        def block(seen: Column, places: Column) -> Column:
            begun = F.struct(*[seen[name].alias(name) for name in kept], none.alias("spans"))

            def done(own: Column) -> Column:
                return F.struct(*[own[name].alias(name) for name in kept], F.array_append(seen["spans"], own["spans"]).alias("spans"))

            return _let(F.aggregate(places, begun, step), done)

        def close(walk: Column) -> Column:
            last = F.when(walk["last"]["end"] > 0, F.array(walk["last"])).otherwise(none)
            return F.concat(F.flatten(walk["spans"]), last)

        start = F.struct(
            F.array_repeat(F.lit(0).cast("long"), -(-len(kind.alphabet) // PACKED)).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            *[F.lit(0).alias(name) for name in ("marked", "hexes", "barred")],
            F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")).alias("last"),
            F.array().cast("array<array<struct<start:int,end:int>>>").alias("spans"),
        )
        # Places of a block by its number; a list of all places would be copied for every block.
        blocks = F.sequence(F.lit(0), F.floor((F.size(codes) - 1) / BLOCK).cast("int"))
        return F.aggregate(
            blocks,
            start,
            lambda seen, k: block(seen, F.sequence(k * BLOCK + 1, F.least((k + 1) * BLOCK, F.size(codes)))),
            close,
        )

    return _let(codes, walked)


def entropy_spans(text: Column) -> Column:
    """(start, number, end) of the stretches of high entropy in candidates that are not on the allow list."""

    def of(candidate: Column) -> Column:
        *special, last = CLASSES
        text, mask = candidate["text"], candidate["mask"]
        spans = _even_windows(text, mask, last)
        for kind in special:
            spans = F.when(text.rlike(kind.pattern), _even_windows(text, mask, kind)).otherwise(spans)
        shift = candidate["start"]
        return F.transform(
            spans,
            lambda s: F.struct((s["start"] + shift).alias("start"), F.lit(len(BASE)).alias("kind"), (s["end"] + shift).alias("end")),
        )

    kept = F.filter(matches(text, CANDIDATE), lambda m: ~_any(m["text"], ALLOWED))
    # Masks are made once for each candidate and not for each of its windows.
    masked = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["text"].alias("text"), _mask(m["text"]).alias("mask")))
    return F.flatten(F.transform(masked, of))


def spans(text: Column) -> Column:
    """All spans of `text` by start and kind: array of (start, kind, end); `kind` is a place in KINDS."""
    whole = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[base_spans(whole, k) for k in range(len(BASE))], entropy_spans(whole)))


KINDS = (*[kind for kind, *_ in BASE], "entropy")


def count(found: Column, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def listed(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def base_only(found: Column) -> Column:
    return F.filter(found, lambda s: s["kind"] < len(BASE))
