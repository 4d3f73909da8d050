"""The message side: broker source and JSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.schemas import MESSAGE

# The default JSON format stops at milliseconds; this one loses nothing.
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of broker records; needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_loss).lower())
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def to_messages(df: DataFrame) -> DataFrame:
    """Message columns as `key, value` with a JSON value.

    The key is the transaction id, which spreads evenly over broker partitions
    where a meter or a region would not.
    """
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGE if f.name in df.columns]
    return df.select(
        F.col("transaction_id").cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"timestampFormat": MICROSECONDS}).alias("value"),
    )


def write_messages(df: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Send rows as `to_messages` makes them to a broker topic, or append them to files of any format.

    For the broker, `options` name the servers and the topic. A file sink needs a path and keeps both columns.
    """
    to_messages(df).write.format(fmt).mode("append").options(**options).save(path)
