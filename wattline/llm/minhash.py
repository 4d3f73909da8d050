"""Near-duplicate documents by MinHash with tensored bands, checked on full shingle sets.

Two collections of SIDE small hashes, each over ROWS minhash values, give SIDE * SIDE tables: the key of table (i, j)
combines hash i of the first collection with hash j of the second. So 2 * SIDE * ROWS minhash values serve as many
tables as SIDE * SIDE * 2 * ROWS values would otherwise. A document needs the keys only of those pairs whose two halves
it shares with some other document; most documents share none and put nothing into tables.

Documents with equal shingle sets are one class, represented by its smallest doc_id. In a bucket every class is first
compared with one hub, the one of lowest number, then with the class that has most links so far. Thousands of copies of one text
so need one comparison each. What shares a bucket and is still in different components goes through an exact filter on
rarest shingles; the groups it leaves are compared in blocks, so that pairs never leave a task. A pair is a link if 100 * intersection >= 75 * union of the
whole sets. At a similarity of exactly 0.75 a pair meets in no table with a probability of 3 in 10,000, at 0.8 of 1 in
100,000.

Words are runs of characters other than white space, A-Z lower-cased. The set holds the distinct runs of five words as
64-bit hashes; a text of fewer words has itself as the one member, a missing or blank text none, and links with nothing.
A row without doc_id links with nothing and is kept. The graph's nodes are classes, numbered apart from the ids: rows that
share a doc_id and differ in their sets are told apart, and each stays or goes with its own class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import as_row, byte_texts, field, list_values, slices, sorted_groups
from wattline.llm.components import components, spanning
from wattline.llm.perfect_hash import mix64
from wattline.session import materialize

WORDS = 5
PERCENT = 75
SIDE = 16
ROWS = 3
SEED = 7
SLICE_BYTES = 1 << 20
CHUNK = 4096
GROUP_BLOCK = 256
COLUMNS = 8192
CACHE_WORDS = 1 << 18
_FOLD = np.uint64(0x9FB21C651E98DF25)


class Shingler:
    """Shingle sets of many texts at a time; hashes of words are remembered until CACHE_WORDS are known."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct 64-bit shingles of each text."""
        docs = [t.lower().split() for t in texts]  # of bytes: ASCII letters and ASCII spaces only
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for w in set().union(*docs).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return [self._set(np.fromiter(map(known.__getitem__, d), np.uint64, len(d))) for d in docs]

    def _set(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if not n:
            return hashes
        width = min(self.words, n)
        out = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            out = mix64(out * _FOLD + hashes[k : n - width + 1 + k])
        return np.unique(out)


class Signer:
    """The 2 * SIDE small hashes of a shingle set."""

    def __init__(self, side: int = SIDE, rows: int = ROWS, seed: int = SEED):
        self.side, self.rows = side, rows
        draw = np.random.default_rng(seed).integers(0, 2**64, (2, 2 * side * rows, 1), np.uint64)
        self.flips, self.factors = draw[0], draw[1] | np.uint64(1)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.flips), 2**64 - 1, np.uint64)
        for start in range(0, len(shingles), CHUNK):
            some = (shingles[None, start : start + CHUNK] ^ self.flips) * self.factors
            np.minimum(low, some.min(axis=1), out=low)
        parts = low.reshape(2 * self.side, self.rows)
        out = np.arange(2 * self.side, dtype=np.uint64)
        for k in range(self.rows):
            out = mix64(out * _FOLD + parts[:, k])
        return out.view(np.int64)


def _sign(words: int, side: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(words), Signer(side, rows)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingler(byte_texts(part.column("text")))
                marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                halves = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
                signed = [signer(s) if len(s) else None for s in sets]
                columns = [
                    part.column("doc_id"),
                    part.column("tie"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(signed, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "n", "set1", "set2", "hashes"])

    return run


def _sets(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = [s.view(np.int64) for s in shingler(byte_texts(part.column("text")))]
                arrays = [part.column("rep"), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["rep", "shingles"])

    return run


def _members(classes: DataFrame, side: int) -> DataFrame:
    """(bucket, rep, n) for buckets of at least two classes."""
    halves = classes.select("rep", F.posexplode("hashes").alias("at", "hash"))
    halves = materialize(halves, "half-keys")
    shared = materialize(halves.groupBy("at", "hash").count().where("count > 1").drop("count"), "shared-halves")
    mine = halves.join(shared, ["at", "hash"]).groupBy("rep").agg(F.collect_list(F.struct("at", "hash")).alias("halves"))
    first = F.filter("halves", lambda h: h["at"] < side)
    second = F.filter("halves", lambda h: h["at"] >= side)
    pairs = mine.select("rep", F.explode(first).alias("a"), second.alias("others"))
    pairs = pairs.select("rep", "a", F.explode("others").alias("b"))
    keyed = pairs.select(F.xxhash64("a.at", "a.hash", "b.at", "b.hash").alias("bucket"), "rep")
    keyed = materialize(keyed, "table-keys")
    full = materialize(keyed.groupBy("bucket").count().where("count > 1").drop("count"), "full-buckets")
    sized = keyed.join(full, "bucket").join(classes.select("rep", "n"), "rep")
    return materialize(sized.select("bucket", "rep", "n"), "bucket-members")


def _fits(a: Column, b: Column) -> Column:
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _with_hub(members: DataFrame, order: Column) -> DataFrame:
    """Pairs (u, v) of each bucket's first class in `order` and its other ones."""
    hubs = members.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), F.col("rep").alias("hub"), F.col("n").alias("hub_n"))).alias("h"))
    hubs = materialize(hubs.select("bucket", "h.hub", "h.hub_n"), "hubs")
    met = members.join(hubs, "bucket").where((F.col("rep") != F.col("hub")) & _fits(F.col("n"), F.col("hub_n")))
    return met.select(F.least("rep", "hub").alias("u"), F.greatest("rep", "hub").alias("v")).distinct()


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links between the sets of two blocks of a group, or within one."""
    for group in sorted_groups(batches, ["group", "left", "right"]):
        rep, root, block = (group.column(c).to_numpy() for c in ("rep", "root", "block"))
        left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
        offsets, values = list_values(group.column("shingles"))
        sizes = np.diff(offsets)
        _, number, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times[number] > 1
        at = np.cumsum(times > 1)[number[shared]] - 1
        owner = np.repeat(np.arange(len(rep)), sizes)[shared]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        common = np.zeros((len(rep), len(rep)), np.float32)
        for start in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
            lo, hi = np.searchsorted(at, (start, start + COLUMNS))
            dense = np.zeros((len(rep), COLUMNS), np.float32)
            dense[owner[lo:hi], at[lo:hi] - start] = 1
            common += dense @ dense.T
        similar = 100 * common >= PERCENT * (sizes[:, None] + sizes[None, :] - common)
        i, j = np.nonzero(similar & (root[:, None] != root[None, :]) & (block[:, None] == left) & (block[None, :] == right))
        if len(i):
            low = rep[spanning(i, j, len(rep))]
            linked = np.flatnonzero(low != rep)
            yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(low[linked])], ["u", "v"])


def _residual_links(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (u, v) that join components among the members of buckets that still hold several.

    Two sets of that similarity share one of the first n - ceil(0.75 n) + 1 shingles of either in any common order. With
    the rarest first, passages that very many texts share come last and bring nobody together. Texts that such a shingle
    does bring together form groups; a group is compared in blocks, and only a spanning forest of links leaves a block.
    """
    left = apart.select("rep", "n", "root").distinct()
    each = sets.join(left, "rep").select("rep", "n", "root", F.explode("shingles").alias("shingle"))
    each = materialize(each, "residual-shingles")
    known = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(materialize(known, "residual-counts"), "shingle")
    whole, rarest = Window.partitionBy("rep"), Window.partitionBy("rep").orderBy("df", "shingle")
    first = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("n") - F.count("*").over(whole))
    prefix = shared.withColumn("first", first).withColumn("at", F.row_number().over(rarest)).where("at <= first")
    prefix = materialize(prefix.select("shingle", "rep", "root"), "rare-shingles")
    mixed = prefix.groupBy("shingle").agg(F.min("rep").alias("v"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    mixed = materialize(mixed.where("lo < hi").select("shingle", "v"), "mixed-shingles")
    groups = components(prefix.join(mixed, "shingle").select(F.col("rep").alias("u"), "v"))
    groups = groups.select(F.col("node").alias("rep"), F.col("root").alias("group"))
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / GROUP_BLOCK).alias("blocks"))
    placed = groups.join(materialize(sizes, "group-sizes"), "group").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    met = placed.select("rep", "group", "block", other).select(
        "rep", "group", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    by = ["group", "left", "right"]
    met = met.join(left.select("rep", "root"), "rep").join(sets, "rep").repartition(*by).sortWithinPartitions(*by)
    return met.mapInArrow(_block_links, "u long, v long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    both = (
        pairs.join(sets.select(F.col("rep").alias("v"), F.col("shingles").alias("y")), "v")
        .join(sets.select(F.col("rep").alias("u"), F.col("shingles").alias("x")), "u")
        .select("u", "v", (F.size("x") + F.size("y")).alias("sum"), F.size(F.array_intersect("x", "y")).alias("common"))
    )
    return both.where(100 * F.col("common") >= PERCENT * (F.col("sum") - F.col("common"))).select("u", "v")


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with their `root`, of buckets that still hold several components."""
    rooted = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    rooted = materialize(rooted, "rooted-members")
    split = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    return materialize(rooted.join(materialize(split.select("bucket"), "split-buckets"), "bucket"), "members-apart")


def _roots(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the classes that have links."""
    tested = materialize(_with_hub(members, F.col("rep")), "hub-pairs")
    links = materialize(_confirmed(tested, sets), "links")
    roots = components(links)
    apart = _apart(members, roots)
    if not apart.isEmpty():
        ends = links.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        pairs = _with_hub(apart.join(ends, "rep", "left"), -F.coalesce("links", F.lit(0)))
        pairs = pairs.join(tested, ["u", "v"], "left_anti")
        links = links.unionByName(materialize(_confirmed(pairs, sets), "links"))
        roots = components(links)
        apart = _apart(members, roots)
        if not apart.isEmpty():
            roots = components(links.unionByName(materialize(_residual_links(apart, sets), "links")))
    return roots


def _decided(docs: DataFrame, doc_id: str, text: str, words: int, side: int, rows: int) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, kept) for every row; `tie` is a hash of the text."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    signed = narrow.mapInArrow(
        _sign(words, side, rows), "doc_id long, tie long, n long, set1 long, set2 long, hashes array<long>"
    )
    signed = materialize(signed, "signatures")
    classes = (
        signed.where("n > 0 and doc_id is not null")
        .groupBy("set1", "set2")
        .agg(F.min(F.struct("doc_id", "tie")).alias("first"), F.any_value("n").alias("n"), F.any_value("hashes").alias("hashes"))
        .select("set1", "set2", "first.doc_id", "first.tie", "n", "hashes", F.monotonically_increasing_id().alias("rep"))
    )
    classes = materialize(classes, "set-classes")
    members = _members(classes, side)
    involved = classes.join(members.select("rep").distinct(), "rep").select("doc_id", "tie", "rep")
    sets = narrow.join(involved, ["doc_id", "tie"]).select("rep", "text").mapInArrow(_sets(words), "rep long, shingles array<long>")
    roots = materialize(_roots(members, materialize(sets, "shingle-sets")), "class-roots")
    linked = materialize(roots.join(classes.select(F.col("rep").alias("node"), "doc_id"), "node"), "linked-classes")
    least = materialize(linked.groupBy("root").agg(F.min("doc_id").alias("component")), "component-names")
    named = linked.join(least, "root").select(F.col("node").alias("rep"), "component")
    about = classes.select("set1", "set2", "doc_id", "rep").join(named, "rep", "left")
    about = materialize(about.select("set1", "set2", F.coalesce("component", "doc_id").alias("component")), "set-components")
    component = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    found = signed.drop("hashes").join(about, ["set1", "set2"], "left").withColumn("component_id", component)
    return found.select(
        "doc_id",
        "tie",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, side: int = SIDE, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; component_id is the smallest doc_id reached by links."""
    return _decided(docs, doc_id, text, words, side, rows).drop("tie")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay: of each component those with the smallest doc_id."""
    decided = materialize(_decided(docs, doc_id, text, WORDS, SIDE, ROWS), "near-duplicates")
    gone = decided.where("not kept").select("doc_id", "tie").distinct()
    same = (field(doc_id).cast("long") == F.col("doc_id")) & (F.xxhash64(field(text)) == F.col("tie"))
    return as_row(docs).join(gone, same, "left_anti").select("row.*")
