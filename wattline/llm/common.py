"""What several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tab, line feed, vertical tab, form feed, carriage return and space.
SPACES = "\t\n\x0b\x0c\r "
#: A word: a longest run of anything else.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and every other character left alone."""
    return F.translate(text, UPPER, LOWER)


def as_row(df: DataFrame) -> DataFrame:
    """The whole row as the one column `row`, so that no added column can clash with one of the caller's."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))


def field(name: str) -> Column:
    return F.col("row").getField(name)


def list_values(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal integer keys in a stream sorted by them; only the current run is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        starts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        cuts = [0, *starts.tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            key = tuple(values[lo])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `max_bytes` of a string or binary column, or of one row if that is longer."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
        yield batch.slice(start, end - start)
        start = end


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is empty."""
    return pc.fill_null(column, "").cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def write_blobs(blobs: DataFrame, path: str) -> None:
    """Each value of the one binary column as a file of its own, followed by a line feed.

    Spark's text writer puts the bytes down as they are, reaches every file system that Spark reaches, and commits the
    files of a task at once, so that a lost executor leaves none behind.
    """
    (name,) = blobs.columns
    blobs.select(F.col(name).cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
