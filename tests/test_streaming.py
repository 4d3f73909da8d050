import glob
import threading
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattline.operators.messages import parse_messages
from wattline.operators.risk import high_value_alerts
from wattline.plans.queries import _event_messages, sale_messages
from wattline.session import new_path
from wattline.sources import broker, files, sinks
from wattline.streaming import ingest, live, progress

ONCE = {"availableNow": True}
REPORTS = ("live_kpis", "live_town_activity", "live_alerts")


def events(spark, small):
    return spark.read.parquet(f"{small}/events.parquet")


def test_stream_equals_batch_and_restart_adds_nothing(spark, small):
    schema = events(spark, small).schema
    path, offsets = new_path(spark, "bronze"), new_path(spark, "offsets")

    def run():
        stream = _event_messages(files.parquet_stream(spark, small, schema, "events.parquet"))
        query = ingest.ingest_stream(stream, path, offsets, ONCE, name="vending_test")
        query.awaitTermination()
        return query

    first = run()
    recent = ingest.stream_progress(first)
    assert recent.agg(F.sum("input_rows")).first()[0] == events(spark, small).count()
    batch = ingest.bronze_stream(_event_messages(events(spark, small)))
    kept = [c for c in batch.columns if c not in ("ingestion_timestamp", "batch_id")]
    stored = files.read_table(spark, path)
    assert stored.select(kept).exceptAll(batch.select(kept)).isEmpty()
    assert stored.count() == batch.count() == stored.select("batch_id").distinct().count()
    run()
    assert files.read_table(spark, path).count() == batch.count()


def test_progress_outlives_its_stream(spark, small):
    """Every batch of a stream and of its restart has a row, and an offset that was seen twice has one."""
    schema = events(spark, small).schema
    path, offsets, table = new_path(spark, "bronze"), new_path(spark, "offsets"), new_path(spark, "progress")
    source = new_path(spark, "arriving")
    parts = events(spark, small).randomSplit([0.5, 0.3, 0.2], seed=1)
    listener = progress.keep_progress(spark, table, names=("kept_progress",))
    try:
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(source)
            stream = _event_messages(files.parquet_stream(spark, source, schema, max_files=1))
            ingest.ingest_stream(stream, path, offsets, ONCE, name="kept_progress").awaitTermination()
        wanted = [p.count() for p in parts]
        for _ in range(100):
            if files.exists(spark, table) and progress.progress_table(spark, table).where("input_rows > 0").count() == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    found = progress.progress_table(spark, table).where("input_rows > 0").orderBy("batch_id").collect()
    assert [r.input_rows for r in found] == wanted
    assert len({r.query_id for r in found}) == 1 and len({r.run_id for r in found}) == 3
    again = spark.createDataFrame([found[0]], progress.PROGRESS).withColumn("run_id", F.lit("later")).withColumn("started_at", F.lit("9"))
    again.write.mode("append").parquet(table)
    kept = progress.progress_table(spark, table).where(F.col("batch_id") == found[0].batch_id).collect()
    assert [r.run_id for r in kept] == ["later"]


def test_messages_come_back_from_files(spark, small):
    sent = sale_messages(spark, small)
    path = new_path(spark, "messages")
    broker.write_messages(sent, "json", path)
    back = parse_messages(files.read_table(spark, path, "json"))
    columns = [c for c in back.columns if c in sent.columns]
    typed = sent.select([F.col(c).cast(back.schema[c].dataType).alias(c) for c in columns])
    assert back.count() == sent.count()
    assert back.select(columns).exceptAll(typed).isEmpty()


def drop(spark, folder, data):
    df = spark.createDataFrame(
        data, "meter_number int, account_number string, town string, purchase_amount double, electricity_units double"
    )
    df.coalesce(1).write.mode("append").option("header", True).csv(folder)
    return df


def report(spark, out, name):
    return spark.read.option("header", True).option("inferSchema", True).csv(live.report_path(spark, out, name))


def test_live_reports_follow_the_latest_batch(spark):
    folder, out, offsets = new_path(spark, "drop"), new_path(spark, "live"), new_path(spark, "offsets")
    data = [(i, f"a{i}", "N" if i % 3 else "S", 60000.0 * i, 1.5) for i in range(1, 70)]
    batch = drop(spark, folder, data)
    schema = files.infer_csv_schema(spark, folder)

    def run():
        stream = files.csv_stream(spark, folder, schema)
        live.start_live(stream, out, offsets, ONCE).awaitTermination()

    run()
    assert rows(report(spark, out, "live_kpis").drop("last_updated")) == rows(live.live_kpis(batch))
    assert rows(report(spark, out, "live_town_activity")) == rows(live.live_town_activity(batch))
    alerts = report(spark, out, "live_alerts")
    assert alerts.count() == 50
    assert rows(alerts, F.desc("purchase_amount")) == rows(high_value_alerts(batch))

    drop(spark, folder, [(1, "a1", "N", 7.0, 1.0)])
    run()
    assert rows(report(spark, out, "live_kpis").drop("last_updated")) == [(7.0, 1.0, 1)]
    assert report(spark, out, "live_alerts").count() == 0
    run()
    assert rows(report(spark, out, "live_kpis").drop("last_updated")) == [(7.0, 1.0, 1)]


def test_empty_batch_leaves_the_reports(spark):
    out = new_path(spark, "live")
    write = live.live_writer(out)
    data = [(1, "a", "N", 5.0, 1.0)]
    batch = spark.createDataFrame(
        data, "meter_number int, account_number string, town string, purchase_amount double, electricity_units double"
    )
    with pytest.raises(FileNotFoundError):
        live.published(spark, out)
    write(batch, 0)
    write(batch.limit(0), 1)
    assert report(spark, out, "live_kpis").first().live_transactions == 1


def test_readers_never_meet_reports_of_two_batches(spark):
    """A reader in a loop finds all three reports of one batch, whatever is being written."""
    out = new_path(spark, "live")
    write = live.live_writer(out)
    schema = "meter_number int, account_number string, town string, purchase_amount double, electricity_units double"
    batches = [spark.createDataFrame([(i, "a", f"T{n}", 200000.0 + n, 1.0) for i in range(n + 1)], schema) for n in range(5)]
    write(batches[0], 0)
    seen, wrong, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            folder = live.published(spark, out).removeprefix("file:")
            lines = {n: len("".join(open(f).read() for f in glob.glob(f"{folder}/{n}/*.csv")).splitlines()) for n in REPORTS}
            kpis = "".join(open(f).read() for f in glob.glob(f"{folder}/live_kpis/*.csv")).splitlines()
            n = int(kpis[1].split(",")[2]) if len(kpis) > 1 else -1
            seen.add(n)
            if lines != {"live_kpis": 2, "live_town_activity": 2, "live_alerts": n + 1}:
                wrong.append((n, lines))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n, batch in enumerate(batches[1:], 1):
            write(batch, n)
    finally:
        time.sleep(0.5)
        done.set()
        reader.join()
    assert not wrong and 5 in seen
    last = live.published(spark, out)
    write(batches[0], 4)
    assert live.published(spark, out) == last
    assert len(glob.glob(f"{out.removeprefix('file:')}/batch-*")) == 2


def test_towns_without_revenue_come_last(spark):
    batch = spark.createDataFrame([("A", None, None), ("B", 1.0, 1.0)], "town string, purchase_amount double, electricity_units double")
    assert [r.town for r in live.live_town_activity(batch).collect()] == ["B", "A"]


def test_broker_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        broker.kafka_source(spark, "localhost:9092", "sales", max_per_trigger=1000)


def test_catalog_table_is_created_once(spark):
    df = spark.range(3)
    path, place = new_path(spark, "table"), new_path(spark, "db")
    first = sinks.ensure_table(spark, "meters", "t", df.schema, path, database_location=place)
    df.write.insertInto(first)
    again = sinks.ensure_table(spark, "meters", "t", df.schema, path)
    assert first == again and spark.table(again).count() == 3
    existing = sinks.ensure_table(spark, "meters", "u", None, path)
    assert spark.table(existing).columns == ["id"]
