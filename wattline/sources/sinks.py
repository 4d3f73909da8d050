"""Writers, output layout and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


#: Rows of a packed CSV file, one task's work for those who read it: some 100 MB of text.
PACKED_ROWS = 500_000


def layout(df: DataFrame, files: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Arrange rows into output files.

    With `by`, rows meet by those columns and AQE splits the large groups and
    merges the small ones towards its advisory size, so a hot month does not
    land in one task. With `files` alone the count is fixed; 1 means a merge
    without a shuffle and suits only small results. With neither, tasks write
    what they hold and nothing is moved.
    """
    if by:
        return df.hint("rebalance", *by)
    if files is None:
        return df
    return df.coalesce(1) if files == 1 else df.repartition(files)


def _packed(fmt: str) -> dict[str, str]:
    """A codec that takes a third less than the default one of Parquet files."""
    return {"compression": "zstd"} if fmt == "parquet" else {}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    writer = df.write.mode(mode).format(fmt).options(**_packed(fmt))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows that may bring new columns.

    Delta merges the schema on write. Parquet keeps each file's own columns and
    `read_table(..., merge_schema=True)` unites them.
    """
    df.write.mode("append").format(fmt).options(**_packed(fmt)).option("mergeSchema", True).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for report-sized results only."""
    write_csv_files(df.coalesce(1), path, "overwrite", packed=False)


def write_csv_files(df: DataFrame, path: str, mode: str = "errorifexists", packed: bool = True) -> None:
    """CSV files with a header; text keeps its leading and trailing blanks.

    Packed files are gzip, written at its fastest level. They are read in one piece, so each holds at most PACKED_ROWS.
    """
    writer = df.write.mode(mode).option("header", True)
    if packed:
        writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        writer.option("maxRecordsPerFile", PACKED_ROWS)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a table; restarts resume from `checkpoint`."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def ensure_table(
    spark: SparkSession,
    database: str,
    name: str,
    schema: T.StructType | None,
    location: str,
    fmt: str = "parquet",
    database_location: str | None = None,
) -> str:
    """Register the table at `location` unless it exists; returns its full name.

    With no schema the table takes that of the files already there.
    """
    place = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    full = f"`{database}`.`{name}`"
    if not spark.catalog.tableExists(full):
        columns = ""
        if schema is not None:
            columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ")"
        spark.sql(f"CREATE TABLE {full} {columns} USING {fmt} LOCATION '{location}'")
    return full
