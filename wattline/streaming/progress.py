"""Progress of streams that outlives them: one row for every micro-batch, in a table.

A query remembers its last hundred batches and forgets them when it ends. A listener on the driver appends each batch's
numbers to a table instead, a small file a trigger, so that a restarted stream goes on in the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wattline.sources.files import read_table
from wattline.sources.sinks import write_table

PROGRESS = (
    "query_id STRING, run_id STRING, name STRING, batch_id LONG, started_at STRING, input_rows LONG, "
    "input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, millis LONG"
)


class ProgressTable(StreamingQueryListener):
    """Appends the progress of every query of a session, or of those named, to the table at `path`."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", names: tuple[str, ...] = ()):
        self.spark, self.path, self.fmt, self.names = spark, path, fmt, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.names and p.name not in self.names:
            return
        row = (
            str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows,
            float(p.inputRowsPerSecond), float(p.processedRowsPerSecond), int(p.batchDuration),
        )
        write_table(self.spark.createDataFrame([row], PROGRESS).coalesce(1), self.path, "append", self.fmt)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def keep_progress(spark: SparkSession, path: str, fmt: str = "parquet", names: tuple[str, ...] = ()) -> ProgressTable:
    """Start recording; `spark.streams.removeListener` with the result ends it."""
    listener = ProgressTable(spark, path, fmt, names)
    spark.streams.addListener(listener)
    return listener


def progress_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row for every batch of every query. Of a batch that was run again after a failure the last run counts."""
    found = spark.read.schema(PROGRESS).format(fmt).load(path) if fmt == "parquet" else read_table(spark, path, fmt)
    latest = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("started_at"), "run_id")
    return found.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")
