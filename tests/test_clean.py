import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.functions.casting import lenient_double, lenient_integer, lenient_timestamp
from wattline.operators import clean
from wattline.schemas import RAW_TRANSACTION


@pytest.mark.parametrize(
    "text, number",
    [
        ("12.0", 12),
        ("0.99999", 0),
        ("12.99996", 12),
        (" 12 ", 12),
        ("9007199254740993.0", 9007199254740993),
        ("1e30", None),
        ("", None),
        (None, None),
        ("x12", None),
        ("-7", -7),
    ],
)
def test_integer_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(lenient_integer(F.col("s"))).first()[0] == number


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("abc", "xx"), ("1.5", "2024-03-05 10:15:00")], "n string, t string")
    got = rows(df.select(lenient_double(F.col("n")), lenient_timestamp(F.col("t"))))
    assert got == [(None, None), (1.5, datetime.datetime(2024, 3, 5, 10, 15))]


def test_vendor_beyond_int_is_null(spark):
    df = spark.createDataFrame([("3000000000",)], "s string")
    assert df.select(lenient_integer(F.col("s"), "int")).first()[0] is None


RECEIPTS = "receipt_number bigint, purchase_amount double"


def test_dedup_treats_null_as_one_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (3, 5.0), (3, 4.0)], RECEIPTS)
    assert rows(clean.dedup(df), "receipt_number") == [(None, 1.0), (3, 4.0)]
    kept = clean.dedup(df, keep_null_keys=True)
    assert rows(kept, "receipt_number", "purchase_amount") == [(None, 1.0), (None, 2.0), (3, 4.0)]


def test_dedup_order_by_column_expression(spark):
    df = spark.createDataFrame([(3, 5.0), (3, 4.0)], RECEIPTS)
    assert rows(clean.dedup(df, order_by=[F.desc("purchase_amount")])) == [(3, 5.0)]
    assert rows(clean.dedup(df, order_by=["purchase_amount"])) == [(3, 4.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.floats(-5, 5)), min_size=1, max_size=30))
def test_dedup_is_idempotent_and_unique(spark, data):
    df = spark.createDataFrame(data, RECEIPTS)
    once = clean.dedup(df)
    assert sorted(map(str, rows(once))) == sorted(map(str, rows(clean.dedup(once))))
    assert once.count() == len({k for k, _ in data})


def test_dedup_does_not_depend_on_partitions(spark):
    df = spark.range(2000).selectExpr("id % 50 as receipt_number", "cast(id as double) as purchase_amount")
    a = rows(clean.dedup(df.repartition(1)), "receipt_number")
    b = rows(clean.dedup(df.repartition(13)), "receipt_number")
    assert a == b


def test_only_positive_sales_stay(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (None,), (7.0,)], "purchase_amount double")
    flags = rows(clean.flag_reversals(df))
    assert flags == [(-5.0, True), (0.0, False), (None, False), (7.0, False)]
    assert rows(clean.keep_sales(df)) == [(7.0, "silver")]


def test_calendar_counts_from_sunday(spark):
    df = spark.createDataFrame([("2024-03-02",), ("2024-03-03",), ("2024-03-04",)], "d string")
    df = df.select(F.to_timestamp("d").alias("transaction_date"))
    got = rows(clean.add_calendar(df).drop("transaction_date"))
    assert got == [(2024, 3, 7, 1), (2024, 3, 1, 1), (2024, 3, 2, 0)]


def test_unit_price(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None)], "purchase_amount double, electricity_units double")
    assert [r.price_per_unit for r in clean.add_unit_price(df).collect()] == [2.5, 0.0, 0.0]


def raw(spark, **values):
    row = {f.name: None for f in RAW_TRANSACTION}
    row.update(values)
    return spark.createDataFrame([tuple(row.values())], RAW_TRANSACTION)


def test_both_spellings_of_columns(spark):
    df = raw(spark, customer_connectdate="2015-01-01", tax_amount="3.5", town=" mjini ", account_number=" AC-001 ")
    other = df.withColumnsRenamed({"customer_connectdate": "customer_connectedate", "tax_amount": "Tax_amount"})
    a, b = clean.silver_clean(df), clean.silver_clean(other)
    assert a.columns == b.columns and rows(a) == rows(b)
    got = a.first()
    assert (got.town, got.account_number, got.tax_amount) == ("MJINI", "AC-001", 3.5)
    assert got.customer_connectdate == datetime.datetime(2015, 1, 1)


def test_cleaning_report_matches_the_steps(spark):
    data = [(1, 5.0), (1, -1.0), (2, 3.0), (None, 4.0), (None, 1.0), (3, None), (4, 0.0)]
    df = spark.createDataFrame(data, RECEIPTS)
    kept = clean.dedup(df)
    report = rows(clean.cleaning_report(df))[0]
    assert report == (7, 7 - kept.count(), kept.filter("purchase_amount > 0").count())


def test_cleaning_report_of_nothing(spark):
    assert rows(clean.cleaning_report(spark.createDataFrame([], RECEIPTS))) == [(0, 0, 0)]


def test_table_report(spark):
    df = spark.createDataFrame([(1, None), (None, "a")], "x int, y string")
    assert rows(clean.table_report(df)) == [("x", "int", 2, 1), ("y", "string", 2, 1)]
