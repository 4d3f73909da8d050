"""From raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before has kept, and is written and read again
before the next one begins. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import lines, minhash, mixing, pieces, quality
from wattline.llm.common import as_row, table
from wattline.session import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit_on_labels(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = as_row(docs).select("row", quality.with_score(docs, model, F.col("row.text")).alias("score"))
    return scored.where("score >= 0.5").select("row.*")


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stay in another one; n_chars follows the text. A missing text stays missing."""
    kept = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    row = F.col("row").withField("text", kept).withField("n_chars", F.length(kept).cast("long"))
    return lines.dedup_lines(docs).select(row.alias("row")).select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their targets; a document comes as often as the mix takes it."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, same_text): ids of every text, and whether they decode to it."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    text = F.coalesce("text", F.lit(""))
    coded = docs.select("doc_id", "source", text.alias("text")).withColumn("ids", pieces.encode(F.col("text"), model))
    decoded = coded.withColumn("decoded", pieces.decode(F.col("ids"), model))
    return decoded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("same_text")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("line dedup", without_shared_lines),
    ("near dedup", without_near_duplicates),
    ("mix", mixed),
    ("token ids", token_ids),
]

#: The classifier and the tokenizer have no SQL form; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
