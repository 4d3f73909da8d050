"""File readers, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, every column as text; malformed rows are kept.

    With `schema` (all text, see `schemas.RAW_TRANSACTION`) no job runs to look
    at the header and a wrong column count shows as NULLs.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def infer_csv_schema(spark: SparkSession, path: str, sampling: float = 1.0) -> T.StructType:
    """Column types guessed from the data; `sampling` below 1 reads a share of the rows."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling)
        .csv(path)
        .schema
    )


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """A stored table. `fmt` may name any installed format, such as delta or orc."""
    return spark.read.format(fmt).option("mergeSchema", merge_schema).load(path)


def csv_stream(
    spark: SparkSession, directory: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """New CSV files of a folder as a stream; `max_files` bounds a micro-batch."""
    reader = spark.readStream.option("header", True).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(directory)


def parquet_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    glob: str = "*.parquet",
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(directory)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at `path`, on any file system that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
