"""Summary tables of the gold layer and its three simple rules.

Monthly, town, payment and daily tables are roll-ups of the same measures, so
they read either transactions or the small day-by-town table `daily_town`.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.measures import flag, stable_avg, stable_std, stable_sum
from wattline.functions.quantiles import attach_scalars
from wattline.schemas import CUSTOMER_KEYS

def _measures(tx: DataFrame) -> DataFrame:
    """Per-row measures; a frame that already has them passes through."""
    if "transactions" in tx.columns:
        return tx
    return tx.select(
        *[c for c in ("town",) if c in tx.columns],
        F.to_date("transaction_date").alias("date"),
        F.col("purchase_amount").alias("revenue"),
        F.col("electricity_units").alias("units"),
        F.lit(1).alias("transactions"),
        F.when(F.col("purchase_amount").isNotNull(), 1).otherwise(0).alias("priced"),
    )


def _roll(tx: DataFrame, keys: dict[str, Column]) -> DataFrame:
    df = _measures(tx)
    return df.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(
        stable_sum(F.col("revenue")).alias("revenue"),
        stable_sum(F.col("units")).alias("units"),
        F.sum("transactions").alias("transactions"),
        F.sum("priced").alias("priced"),
    )


def _average() -> Column:
    return F.try_divide(F.col("revenue"), F.col("priced"))


def daily_town(tx: DataFrame) -> DataFrame:
    """Measures per day and town: one scan that feeds every calendar and town table."""
    return _roll(tx, {"date": F.col("date"), "town": F.col("town")})


def monthly_revenue(tx: DataFrame) -> DataFrame:
    return _roll(tx, {"year": F.year("date"), "month": F.month("date")}).select(
        "year",
        "month",
        F.col("revenue").alias("total_revenue"),
        F.col("units").alias("total_units_sold"),
        F.col("transactions").alias("total_transactions"),
        _average().alias("avg_purchase_amount"),
    )


def town_summary(tx: DataFrame) -> DataFrame:
    return _roll(tx, {"town": F.col("town")}).select(
        "town",
        F.col("revenue").alias("total_revenue"),
        F.col("units").alias("total_units_sold"),
        F.col("transactions").alias("total_transactions"),
        _average().alias("avg_purchase_amount"),
    )


def payment_trends(tx: DataFrame) -> DataFrame:
    keys = {"year": F.year("date"), "month": F.month("date"), "town": F.col("town")}
    return _roll(tx, keys).select(
        "year",
        "month",
        "town",
        F.col("revenue").alias("monthly_town_revenue"),
        F.col("transactions").alias("monthly_town_transactions"),
        _average().alias("avg_payment_value"),
    )


def daily_features(tx: DataFrame) -> DataFrame:
    """One row per selling day; rows without a date are left out."""
    df = _measures(tx).filter(F.col("date").isNotNull())
    return _roll(df, {"date": F.col("date")}).select(
        "date",
        F.col("revenue").alias("daily_revenue"),
        F.col("units").alias("daily_units_sold"),
        F.col("transactions").alias("daily_transactions"),
        _average().alias("avg_purchase_amount"),
    )


def customer_summary(tx: DataFrame) -> DataFrame:
    amount = F.col("purchase_amount")
    return tx.groupBy("meter_number", "account_number").agg(
        stable_sum(amount).alias("customer_total_spent"),
        stable_sum(F.col("electricity_units")).alias("customer_total_units"),
        F.count("*").alias("customer_transactions"),
        stable_avg(amount).alias("customer_avg_purchase"),
        F.max("transaction_date").alias("last_purchase_date"),
        F.min("transaction_date").alias("first_purchase_date"),
    )


def customer_summary_from(profile: DataFrame) -> DataFrame:
    """`customer_summary` rolled up from `features.customer_profile`."""
    spent = stable_sum(F.col("total_spent"))
    return profile.groupBy("meter_number", "account_number").agg(
        spent.alias("customer_total_spent"),
        stable_sum(F.col("total_units")).alias("customer_total_units"),
        F.sum("transaction_count").alias("customer_transactions"),
        F.try_divide(spent, F.sum("priced_count")).alias("customer_avg_purchase"),
        F.max("last_transaction_time").alias("last_purchase_date"),
        F.min("first_transaction_time").alias("first_purchase_date"),
    )


_FRAUD_BASE = {
    "transaction_count": "transaction_count",
    "total_spent": "total_spent",
    "avg_purchase": "avg_purchase",
    "std_purchase": "std_purchase",
    "max_purchase": "max_purchase",
    "min_purchase": "min_purchase",
    "total_units": "total_units",
    "last_transaction_date": "last_transaction_time",
}


def fraud_base(tx: DataFrame) -> DataFrame:
    """Spending statistics per meter, account and town."""
    amount = F.col("purchase_amount")
    return tx.groupBy(*CUSTOMER_KEYS).agg(
        F.count("*").alias("transaction_count"),
        stable_sum(amount).alias("total_spent"),
        stable_avg(amount).alias("avg_purchase"),
        stable_std(amount).alias("std_purchase"),
        F.max(amount).alias("max_purchase"),
        F.min(amount).alias("min_purchase"),
        stable_sum(F.col("electricity_units")).alias("total_units"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def fraud_base_from(profile: DataFrame) -> DataFrame:
    """`fraud_base` read off `features.customer_profile`."""
    return profile.select(
        *CUSTOMER_KEYS, *[F.col(source).alias(name) for name, source in _FRAUD_BASE.items()]
    )


def as_of_column(tx: DataFrame, as_of: Column | datetime.date | None) -> Column:
    """The reference day: the given one, or the last day in the data."""
    if as_of is None:
        return tx.agg(F.max(F.to_date("transaction_date"))).scalar()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def anomaly_rules(base: DataFrame, as_of: Column | datetime.date, exact: bool = True) -> DataFrame:
    """High-value, frequent and inactive flags; the score counts the first two.

    The 95th percentile is taken over transaction counts. Distinct counts add up
    to at most the number of rows, so there are at most about sqrt(2 x rows) of
    them and the exact percentile stays small: 1.4 million for 10^12 rows.
    """
    count = F.col("transaction_count")
    p95 = F.percentile(count, 0.95) if exact else F.percentile_approx(count, 0.95).cast("double")
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return (
        attach_scalars(base, base.agg(p95.alias("p95")))
        .withColumns(
            {
                "high_value_flag": flag(F.col("max_purchase") > 100000),
                "frequent_transaction_flag": flag(count > F.col("stats.p95")),
                "inactive_customer_flag": flag(F.date_diff(day, F.to_date("last_transaction_date")) > 90),
            }
        )
        .withColumn("anomaly_score", F.col("high_value_flag") + F.col("frequent_transaction_flag"))
        .drop("stats")
    )
