"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets the Efraimidis-Spirakis key -ln(u) / w, where u is a hash of its id and w its quality weight; reading
a source by ascending key is a sample in which good documents come first more often. A source whose target is several
times its size is taken whole that many times, and what is left of the target is filled by a prefix in key order.

The prefix ends at one key of each source, its cut. To find it nothing has to be sorted as a whole: keys fall into cells
of nearly equal numbers of rows, the cells' sums tell in which cell the target is met, and only that cell is sorted. A
document is then taken by comparing its own key with its source's cut, so texts are never shuffled.

Rows without an id share one key and are told apart by their text. Rows equal in id and text stand or fall together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import WORD, as_row, field
from wattline.session import materialize

#: Smallest quality weight; bounds how unevenly keys fall into cells.
LEAST_WEIGHT = 0.125
CELL_ROWS = 4096
CAP = 3
SEED = "mix"
CYCLE = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Latin letters per character; 0 for an empty or missing text."""
    letters = F.length(F.regexp_replace(text, "[^A-Za-zÀ-ɏ]+", ""))
    return F.coalesce(F.try_divide(letters.cast("double"), F.length(text).cast("double")), F.lit(0.0))


def sample_key(doc_id: Column, quality: Column, seed: str = SEED) -> Column:
    """-ln(u) / w with 52 bits of u, the same on every run."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10)
    u = (bits.cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(1.0), F.coalesce(quality, F.lit(0.0))))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as `row`, with what sampling needs beside them."""
    return as_row(docs).select(
        "row",
        field(source).alias("source"),
        word_count(field(text)).alias("size"),
        sample_key(field(doc_id), letter_share(field(text))).alias("key"),
        F.xxhash64(field(text)).alias("tie"),
    )


def targets(sizes: DataFrame, cycle: Sequence[int] = CYCLE, cap: int = CAP) -> DataFrame:
    """Targets of `sizes` (source, source_size): source_size, target, whole epochs and the part left over.

    Sources by code point, nulls last, weigh as `cycle` says and share the sum of all sizes. A target stops at `cap`
    times its source's size and the excess goes to the others by weight. With sources in the order in which they reach
    their caps, the share per weight follows from sums over those before. The table has a row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in cycle])
    weighed = sizes.withColumn("weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(cycle) + 1))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    most = (F.col("source_size") * cap).cast("double")
    return (
        weighed.withColumn("place", F.row_number().over(by_ratio))
        .withColumn(
            "rest",
            (F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))).cast("double"),
        )
        .withColumn("weights", F.sum("weight").over(onward).cast("double"))
        .withColumn("open", F.col("rest") * F.col("weight") / F.col("weights") < most)
        .withColumn("first_open", F.min(F.when(F.col("open"), F.struct("place", "rest", "weights"))).over(whole))
        .withColumn(
            "target",
            F.when(
                F.col("place") >= F.col("first_open.place"),
                F.col("first_open.rest") * F.col("weight") / F.col("first_open.weights"),
            ).otherwise(most),
        )
        .withColumn("epochs", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long"))
        .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("source", "source_size", "weight", "target", "epochs", "left")
    )


def _cell(cells: int) -> Column:
    """Place of a key among `cells`; no cell holds more than 1 / LEAST_WEIGHT times an even share."""
    return F.floor(F.lit(float(cells)) * (F.lit(1.0) - F.exp(-F.col("key") * F.lit(LEAST_WEIGHT))))


def cuts(narrow: DataFrame, cycle: Sequence[int] = CYCLE, cap: int = CAP, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row for each source: its targets and `cut`, the key and tie of the last document in its partial epoch.

    `narrow` (source, size, key, tie) is read three times and should be stored.
    """
    cell = _cell(max(1, -(-narrow.count() // cell_rows)))
    sums = materialize(
        narrow.groupBy("source", cell.alias("cell")).agg(
            F.sum("size").alias("words"), F.max(F.struct("key", "tie")).alias("last")
        ),
        "mix-cells",
    )
    plan = materialize(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), cycle, cap), "mix-targets")
    in_order = Window.partitionBy("source").orderBy("cell")
    running = sums.withColumn("upto", F.sum("words").over(in_order)).withColumn(
        "earlier", F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    )
    r, p = running.alias("r"), plan.alias("p")
    crossed = (
        r.join(p, F.col("r.source").eqNullSafe(F.col("p.source")))
        .where(F.col("upto") > F.col("left"))
        .groupBy("r.source")
        .agg(F.min(F.struct("cell", (F.col("upto") - F.col("words")).alias("before"), "left", "earlier")).alias("at"))
        .select("source", "at.*")
    )
    crossed = materialize(crossed, "mix-crossed")
    n, c = narrow.withColumn("cell", cell).alias("n"), crossed.alias("c")
    groups = (
        n.join(c, F.col("n.source").eqNullSafe(F.col("c.source")) & (F.col("n.cell") == F.col("c.cell")))
        .groupBy("n.source", "key", "tie", "before", "left")
        .agg(F.sum("size").alias("words"))
    )
    upto = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key", "tie"))
    # A document is in while at least half of it fits, so a source ends within half a document of its target.
    last = (
        groups.withColumn("upto", upto)
        .where(2 * F.col("upto") - F.col("words") <= 2 * F.col("left"))
        .groupBy("source")
        .agg(F.max(F.struct("key", "tie")).alias("last"))
    )
    k = last.alias("k")
    cut = c.join(k, F.col("c.source").eqNullSafe(F.col("k.source")), "left").select(
        F.col("c.source").alias("source"), F.coalesce("k.last", "earlier").alias("cut")
    )
    q = cut.alias("q")
    out = p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")), "left").select("p.*", "q.cut")
    return materialize(out, "mix-cuts")


def decide(keyed_docs: DataFrame, cut: DataFrame) -> DataFrame:
    """`keyed_docs` with source_size, target and `copies`, how often the mix takes the document."""
    d, c = keyed_docs.alias("d"), cut.alias("c")
    extra = (F.struct("d.key", "d.tie") <= F.col("c.cut")).cast("long")
    return d.join(c, F.col("d.source").eqNullSafe(F.col("c.source")), "left").select(
        "d.*", "c.source_size", "c.target", (F.col("c.epochs") + F.coalesce(extra, F.lit(0))).alias("copies")
    )


def mix(
    docs: DataFrame,
    cycle: Sequence[int] = CYCLE,
    cap: int = CAP,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mixed corpus: the columns of `docs`, each document repeated as often as it is taken, or left out.

    A missing or empty text has size 0 and comes along with its neighbours in key order. A missing source is a source
    of its own. An empty table gives an empty mix.
    """
    rows = keyed(docs, doc_id, text, source)
    cut = cuts(materialize(rows.drop("row"), "mix-keys"), cycle, cap)
    taken = decide(rows, cut).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
