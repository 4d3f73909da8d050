"""Live indicators: three small reports that follow the latest micro-batch.

The reports of a batch are published as one. They are written to a folder of their own first; then an empty marker file
named after it appears, which is one step on every file system, and the newest marker is what counts. A reader that asks
for it meets three reports of one batch at any time. The folder before the current one stays for readers still in it.
One query, with one checkpoint, writes to a folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.functions.measures import stable_sum
from wattline.operators.clean import stamp
from wattline.operators.risk import high_value_alerts
from wattline.sources.sinks import write_csv


def _number(name: str):
    return F.col(name).try_cast("double")


def live_kpis(batch: DataFrame) -> DataFrame:
    return batch.agg(
        stable_sum(_number("purchase_amount")).alias("live_revenue"),
        stable_sum(_number("electricity_units")).alias("live_units_sold"),
        F.count("*").alias("live_transactions"),
    )


def _per_town(batch: DataFrame) -> DataFrame:
    return batch.groupBy("town").agg(
        stable_sum(_number("purchase_amount")).alias("live_town_revenue"),
        F.count("*").alias("live_town_transactions"),
    )


def live_town_activity(batch: DataFrame, n: int = 20) -> DataFrame:
    return _per_town(batch).orderBy(F.desc_nulls_last("live_town_revenue"), "town").limit(n)


MARKER, FOLDER = "published-", "batch-"


def _listed(spark: SparkSession, out_dir: str, start: str) -> list[str]:
    """Sorted names below `out_dir` that begin with `start`."""
    place = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(n for n in names if n.startswith(start))


def _published(spark: SparkSession, out_dir: str) -> tuple[int, int, str] | None:
    """How many batches have been published, the number of the last one, and its folder's name."""
    markers = _listed(spark, out_dir, MARKER)
    if not markers:
        return None
    place, batch_id, folder = markers[-1].removeprefix(MARKER).split("-", 2)
    return int(place), int(batch_id), folder


def _publish(spark: SparkSession, out_dir: str, place: int, batch_id: int, folder: str) -> None:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{MARKER}{place:012d}-{batch_id}-{folder}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, False).close()


def report_path(spark: SparkSession, out_dir: str, name: str) -> str:
    """Where a report of the published batch lies. Reports read by one call of `published` are of one batch."""
    return f"{published(spark, out_dir)}/{name}"


def published(spark: SparkSession, out_dir: str) -> str:
    """The folder with the reports of the published batch."""
    current = _published(spark, out_dir)
    if current is None:
        raise FileNotFoundError(f"no batch has been published in {out_dir}")
    return f"{out_dir}/{current[2]}"


def live_writer(out_dir: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` callback that publishes the reports of a batch below `out_dir`.

    An empty batch leaves the previous reports in place. A batch that is published already and comes again after a
    failure changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _published(spark, out_dir)
        if before and before[1] == batch_id:
            return
        kept = batch.select("meter_number", "account_number", "town", "purchase_amount", "electricity_units")
        kept = kept.persist()
        try:
            if kept.isEmpty():
                return
            folder = f"{FOLDER}{batch_id}-{uuid.uuid4().hex[:8]}"
            write_csv(live_kpis(kept).transform(stamp, "last_updated"), f"{out_dir}/{folder}/live_kpis")
            write_csv(live_town_activity(kept), f"{out_dir}/{folder}/live_town_activity")
            write_csv(high_value_alerts(kept), f"{out_dir}/{folder}/live_alerts")
        finally:
            kept.unpersist()
        _publish(spark, out_dir, before[0] + 1 if before else 0, batch_id, folder)
        _forget(spark, out_dir, {folder, before[2] if before else folder})

    return write


def _forget(spark: SparkSession, out_dir: str, kept: set[str]) -> None:
    """Remove the folders and markers of batches that are neither the current one nor the one before."""
    old = [n for n in _listed(spark, out_dir, MARKER) if n.split("-", 3)[3] not in kept]
    old += [n for n in _listed(spark, out_dir, FOLDER) if n not in kept]
    for name in old:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{name}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def start_live(
    stream: DataFrame, out_dir: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(live_writer(out_dir))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
