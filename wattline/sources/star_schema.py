"""Canonical transactions out of an order-line star schema.

Every order line is one sale. The other tables only look up columns, each by a
unique key, so they are joined from the left and only when one of their columns
is asked for: a monthly total never touches orders or customers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.schemas import TRANSACTION

_COLUMNS: dict[str, tuple[str, str]] = {
    # column: (table it needs, expression)
    "transaction_date": ("lineitem", "cast(l_shipdate as timestamp)"),
    "vendor_id": ("lineitem", "l_suppkey"),
    "meter_number": ("orders", "o_custkey"),
    "account_number": ("customer", "c_name"),
    "receipt_number": ("lineitem", "l_orderkey * 10 + l_linenumber"),
    "purchase_amount": ("lineitem", "l_extendedprice"),
    "electricity_units": ("lineitem", "l_quantity"),
    "tax_amount": ("lineitem", "l_extendedprice * l_tax"),
    "tariff_charge": ("lineitem", "l_discount"),
    "fixed_charge": ("lineitem", "0.0D"),
    "arrears_paid": ("lineitem", "0.0D"),
    "consumer_surname": ("customer", "c_name"),
    "consumer_first_name": ("customer", "c_mktsegment"),
    "customer_connectdate": ("orders", "cast(o_orderdate as timestamp)"),
    "vending_category": ("customer", "c_mktsegment"),
    "town": ("town", "n_name"),
    "outstanding_amount": ("customer", "c_acctbal"),
}


def transactions(
    spark: SparkSession,
    folder: str,
    columns: Iterable[str] | None = None,
    town: str = "customer",
) -> DataFrame:
    """`columns` (default all) of the transactions found in `folder`.

    `town` is the nation of the customer, or of the supplier, which gives one
    meter several towns.
    """
    wanted = list(columns) if columns is not None else TRANSACTION.fieldNames()
    needs = {_COLUMNS[c][0] for c in wanted}

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    df = table("lineitem")
    by_customer = "town" in needs and town == "customer"
    if needs & {"orders", "customer"} or by_customer:
        # An order looks up its customer before the sales look up their order: that moves orders, not sales, by customer.
        bought = table("orders")
        if "customer" in needs or by_customer:
            bought = bought.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        if by_customer:
            bought = bought.join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        df = df.join(bought, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "town" in needs and town == "supplier":
        df = df.join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        df = df.join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return df.select(*[F.expr(_COLUMNS[c][1]).alias(c) for c in wanted])


def latest_date(spark: SparkSession, folder: str) -> Column:
    """Last selling day as a scalar, read from one column of one table."""
    return transactions(spark, folder, ["transaction_date"]).agg(F.max(F.to_date("transaction_date"))).scalar()


def event_transactions(events: DataFrame) -> DataFrame:
    """The event table as live sales, usable on a batch or a stream."""
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("transaction_date"),
        F.col("user_id").alias("meter_number"),
        F.col("user_id").cast("string").alias("account_number"),
        F.col("event_type").alias("town"),
        (F.col("value") * 1000).alias("purchase_amount"),
        F.col("value").alias("electricity_units"),
    )
