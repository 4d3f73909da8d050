"""Removing lines that many documents share, through perfect-hash arrays instead of a join of lines.

A line's key is the line without surrounding white space and with A-Z lower-cased. Counting runs over 128-bit hashes of
the keys of each document, combined before the shuffle. Keys in `min_docs` documents or more go into shards; a shard is
a minimal perfect hash with an array of fingerprints, one of counts and one of the largest doc_id holding the line.
Documents look their lines up in these arrays.

The arrays take about 28 bytes for a line that is to go. While all shards together stay below `broadcast_bytes`, which is
checked, every task gets all of them and neither lines nor texts are shuffled. Beyond that, line hashes are sent to the
shard that answers for them, in portions so that a line common to a third of the corpus is spread over many tasks.

A missing or empty text is one empty line. A missing doc_id counts as smaller than any other; a line found only in
documents without an id is kept in all of them. Every row is a document, so repeated rows count one by one and a line
stays in all rows that share the largest doc_id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SPACES, as_row, field, list_values, lower_ascii
from wattline.llm.perfect_hash import PerfectHash
from wattline.session import materialize

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 16
BROADCAST_BYTES = 64 << 20
PORTION_LINES = 1 << 19
NO_ID = -(2**63)

_SHARD = (
    "shard long, sizes binary, words binary, ranks binary, prints binary, counts binary, keepers binary"
)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keys(text: Column) -> Column:
    return F.transform(_lines(lower_ascii(text)), lambda line: F.btrim(line, F.lit(SPACES)))


def _halves(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit("line"), key), F.xxhash64(key)


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(hi, lo, n_docs, keeper) of the keys of `docs` (doc_id, text) in at least `min_docs` documents."""
    long_keys = F.filter(_keys(F.col("text")), lambda key: F.length(key) >= min_chars)
    each = docs.select("doc_id", F.explode(F.array_distinct(long_keys)).alias("key"))
    hi, lo = _halves(F.col("key"))
    return (
        each.select("doc_id", hi.alias("hi"), lo.alias("lo"))
        .groupBy("hi", "lo")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )


def _build(part: pd.DataFrame) -> pd.DataFrame:
    hi = part["hi"].to_numpy(np.int64).view(np.uint64)
    lo = part["lo"].to_numpy(np.int64).view(np.uint64)
    table = PerfectHash.build(hi, lo)
    order = np.argsort(table.places(hi, lo))
    arrays = [
        table.sizes,
        table.words,
        table.ranks,
        hi[order],
        part["n_docs"].to_numpy(np.int64)[order],
        part["keeper"].to_numpy(np.int64)[order],
    ]
    names = ["sizes", "words", "ranks", "prints", "counts", "keepers"]
    return pd.DataFrame({"shard": [part["shard"].iloc[0]]} | {n: [a.tobytes()] for n, a in zip(names, arrays, strict=True)})


def line_shards(shared: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The stored shards of `shared` and their number."""
    shared = materialize(shared, "shared-lines")
    n = max(1, -(-shared.count() // shard_keys))
    keyed = shared.select(
        F.pmod("lo", F.lit(n)).alias("shard"), "hi", "lo", "n_docs", F.coalesce("keeper", F.lit(NO_ID)).alias("keeper")
    )
    return materialize(keyed.groupBy("shard").applyInPandas(_build, _SHARD), "line-shards"), n


class Shard:
    """The arrays of one shard."""

    def __init__(self, row):
        read = lambda name, kind: np.frombuffer(bytes(row[name]), kind)
        self.table = PerfectHash(read("sizes", np.int64), read("words", np.uint64), read("ranks", np.uint32))
        self.prints, self.counts = read("prints", np.uint64), read("counts", np.int64)
        self.keepers = read("keepers", np.int64)

    def drops(self, hi: np.ndarray, lo: np.ndarray, doc_id: np.ndarray, min_docs: int) -> np.ndarray:
        """Whether each line goes: known, in enough documents, and kept in another one."""
        if not len(self.prints):
            return np.zeros(len(hi), bool)
        at = self.table.places(hi, lo)
        known = (at >= 0) & (self.prints[at] == hi) & (self.counts[at] >= min_docs)
        return known & (self.keepers[at] != NO_ID) & (self.keepers[at] != doc_id)


def _asker(shared, n: int, min_docs: int) -> Callable:
    """An Arrow function of (doc_id, hi, lo) that tells for every line of a document whether it goes."""
    opened: dict[int, Shard] = {}

    def ask(doc_id: pa.Array, hi: pa.Array, lo: pa.Array) -> pa.Array:
        if not opened:
            opened.update({row["shard"]: Shard(row) for row in shared.value})
        offsets, high = list_values(hi)
        _, low = list_values(lo)
        owner = np.repeat(doc_id.fill_null(NO_ID).to_numpy(zero_copy_only=False), np.diff(offsets))
        out = np.zeros(len(high), bool)
        asked = np.flatnonzero((high != 0) | (low != 0))
        shard = low[asked] % n
        for number, arrays in opened.items():
            mine = asked[shard == number]
            out[mine] = arrays.drops(high[mine].view(np.uint64), low[mine].view(np.uint64), owner[mine], min_docs)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out))

    return ask


def _answer(min_docs: int) -> Callable:
    def answer(asked: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if arrays.empty or asked.empty:
            return pd.DataFrame({"doc": [], "same": [], "line": []}).astype({"doc": "int64", "same": "int64", "line": "int32"})
        hi, lo = (asked[c].to_numpy(np.int64).view(np.uint64) for c in ("hi", "lo"))
        goes = Shard(arrays.iloc[0]).drops(hi, lo, asked["doc_id"].to_numpy(np.int64), min_docs)
        return asked.loc[goes, ["doc", "same", "line"]]

    return answer


def _routed(rows: DataFrame, shards: DataFrame, n: int, min_docs: int) -> DataFrame:
    """`rows` with `gone`, the places of the lines that go, found by sending line hashes to their shards."""
    asked = rows.select("doc", "same", "doc_id", F.posexplode(F.arrays_zip("hi", "lo")).alias("line", "at")).select(
        "doc", "same", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "line", "at.*"
    )
    asked = asked.where("hi != 0 or lo != 0").withColumn("shard", F.pmod("lo", F.lit(n)))
    load = asked.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    portions = max(1, -(-load // PORTION_LINES))
    asked = asked.withColumn("portion", F.pmod(F.xxhash64("doc", "line"), F.lit(portions)))
    copies = shards.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(portions - 1).cast("long"))))
    by = ["shard", "portion"]
    found = asked.groupBy(*by).cogroup(copies.groupBy(*by)).applyInPandas(_answer(min_docs), "doc long, same long, line int")
    gone = found.groupBy("doc", "same").agg(F.collect_set("line").alias("gone"))
    r, g = rows.alias("r"), gone.alias("g")
    joined = r.join(g, (F.col("r.doc") == F.col("g.doc")) & (F.col("r.same") == F.col("g.same")), "left")
    flags = F.transform("r.hi", lambda _, i: F.coalesce(F.array_contains("g.gone", i), F.lit(False)))
    return joined.select("r.row", flags.alias("drops"))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    broadcast_bytes: int = BROADCAST_BYTES,
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """`row` (the columns of `docs`), `kept` (the text that stays), `n_lines` and `n_dropped`."""
    shared = shared_lines(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), min_chars, min_docs)
    shards, n = line_shards(shared, shard_keys)
    sized = [F.sum(F.length(c)) for c in ("sizes", "words", "ranks", "prints", "counts", "keepers")]
    size = sum(x or 0 for x in shards.agg(*sized).first())

    def half(i: int) -> Column:
        zero = F.lit(0).cast("long")
        return F.transform("keys", lambda k: F.when(F.length(k) >= min_chars, _halves(k)[i]).otherwise(zero))

    rows = as_row(docs).withColumn("doc_id", field(doc_id).cast("long")).withColumn("keys", _keys(field(text)))
    rows = rows.select("row", "doc_id", half(0).alias("hi"), half(1).alias("lo"))
    if size <= broadcast_bytes:
        known = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in shards.collect()])
        ask = F.arrow_udf(_asker(known, n, min_docs), "array<boolean>")
        flagged = rows.select("row", ask("doc_id", "hi", "lo").alias("drops"))
    else:
        same = [F.xxhash64(F.lit(salt), "doc_id", field(text)).alias(name) for salt, name in ((1, "doc"), (2, "same"))]
        flagged = _routed(rows.select("*", *same), shards, n, min_docs)
    lines = _lines(field(text))
    stays = F.filter(lines, lambda _, i: ~F.get("drops", i))
    return flagged.select(
        "row",
        F.array_join(stays, "\n").alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter("drops", lambda d: d)).cast("long").alias("n_dropped"),
    )
