import datetime

from conftest import rows
from pyspark.sql import functions as F

from wattline.operators import messages
from wattline.plans.queries import sale_messages
from wattline.schemas import BRONZE_MESSAGE, MESSAGE
from wattline.sources.broker import to_messages
from wattline.streaming.ingest import bronze_stream


def parsed(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return messages.parse_messages(df)


def test_bad_json_is_dropped_and_bad_fields_are_null(spark):
    df = parsed(
        spark,
        "not json",
        None,
        '{"transaction_id":"a","transaction_date":"zz","purchase_amount":"abc","region":"N"}',
        '{"transaction_id":"b","transaction_date":"2024-01-02T03:04:05.678901"}',
        '{"transaction_id":"c","transaction_date":1704067200}',
    )
    assert df.columns == MESSAGE.fieldNames() and dict(df.dtypes)["transaction_date"] == "timestamp"
    got = rows(messages.drop_empty(df).select("transaction_id", "transaction_date", "purchase_amount", "region"))
    assert got == [
        ("a", None, None, "N"),
        ("b", datetime.datetime(2024, 1, 2, 3, 4, 5, 678901), None, None),
        ("c", datetime.datetime(2024, 1, 1), None, None),
    ]


def test_binary_value_as_a_broker_sends_it(spark):
    df = spark.createDataFrame([('{"transaction_id":"a"}',)], "value string").select(F.encode("value", "utf-8").alias("value"))
    assert messages.parse_messages(df).first().transaction_id == "a"


def test_parse_reverses_to_messages(spark, small):
    sent = sale_messages(spark, small)
    back = messages.parse_messages(to_messages(sent))
    assert back.exceptAll(sent).isEmpty() and sent.exceptAll(back).isEmpty()


def test_bronze_columns(spark):
    df = spark.createDataFrame([('{"transaction_id":"a"}',), ('{"transaction_id":"b"}',)], "value string")
    got = bronze_stream(df)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BRONZE_MESSAGE]
    ids = [r.batch_id for r in got.collect()]
    assert len(set(ids)) == 2 and None not in ids
    assert {(r.source_file, r.data_quality_status) for r in got.collect()} == {("kafka", "PENDING")}


def now():
    return F.lit("2024-05-06 00:00:00").cast("timestamp")


def test_normalize_defaults(spark):
    df = spark.createDataFrame([(7,)], "row_id bigint")
    got = messages.normalize_messages(df, now()).first().asDict()
    assert got == {
        "transaction_id": "TXN_7_1714953600",
        "meter_id": "METER_7",
        "token_id": "TOKEN_7",
        "purchase_amount": 0.0,
        "units_purchased": 0.0,
        "vendor_id": "VENDOR_001",
        "vending_point_id": "VP_001",
        "transaction_date": datetime.datetime(2024, 5, 6),
        "payment_method": "CASH",
        "customer_id": "CUST_7",
        "region": "UNKNOWN",
    }


def test_normalize_aliases(spark):
    df = spark.createDataFrame(
        [(1, None, "5", "2", "V", "2024-01-01", "2023-01-01"), (2, "bad", "5", "x", None, None, "2023-01-01")],
        "row_id bigint, purchase_amount string, amount string, units string, vending_point string, timestamp string, date string",
    )
    got = messages.normalize_messages(df, now()).select(
        "purchase_amount", "units_purchased", "vending_point_id", "transaction_date"
    )
    assert rows(got) == [
        (5.0, 2.0, "V", datetime.datetime(2024, 1, 1)),
        (0.0, 0.0, "VP_001", datetime.datetime(2023, 1, 1)),
    ]


def test_canonical_keeps_text_ids(spark):
    df = parsed(spark, '{"transaction_id":"TXN_1","meter_id":"M1"}', '{"transaction_id":"TXN_2","meter_id":"M1"}')
    got = messages.to_canonical(df)
    assert [r.receipt_number for r in got.collect()] == ["TXN_1", "TXN_2"]
