"""Message stream to the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wattline.operators.messages import add_lineage, drop_empty, parse_messages
from wattline.sources.sinks import start_append


def bronze_stream(messages: DataFrame, source: str = "kafka") -> DataFrame:
    """Parsed, stamped messages; works on a batch as well."""
    return messages.transform(parse_messages).transform(drop_empty).transform(add_lineage, source)


def ingest_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = "bronze_ingest",
    source: str = "kafka",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Start the ingest of a stream with a `value` column into the table at `path`.

    The job keeps no state: offsets live in the checkpoint and files are
    committed per batch, so a restart neither loses nor repeats rows.
    """
    return start_append(bronze_stream(messages, source), path, checkpoint, trigger, name, fmt)


def stream_progress(query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch: its id, start and input rows."""
    spark = SparkSession.getActiveSession()
    rows = [(p["batchId"], p["timestamp"], p["numInputRows"]) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id BIGINT, started_at STRING, input_rows BIGINT")
