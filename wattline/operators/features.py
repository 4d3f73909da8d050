"""Per-customer behaviour features."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.casting import finite_or_zero, guarded_ratio
from wattline.functions.measures import count_where, stable_avg, stable_std, stable_sum
from wattline.functions.quantiles import attach_scalars
from wattline.operators.gold import as_of_column
from wattline.schemas import CUSTOMER_KEYS, MODEL_FEATURES
from wattline.session import materialize

RECENT_DAYS = 30


def with_date(df: DataFrame, ts: str = "transaction_date", out: str = "date", drop_null: bool = False) -> DataFrame:
    dated = df.withColumn(out, F.to_date(ts))
    return dated.filter(F.col(out).isNotNull()) if drop_null else dated


def _split(age: Column, days: int) -> dict[str, Column]:
    return {"recent": age <= days, "historical": age > days}


def _window_parts(age: Column, days: int) -> list[Column]:
    """Sums and counts of both windows; averages are formed after they are added up."""
    amount, units = F.col("purchase_amount"), F.col("electricity_units")
    parts = []
    for name, inside in _split(age, days).items():
        parts += [
            count_where(inside).alias(f"{name}_rows"),
            stable_sum(F.when(inside, units)).alias(f"{name}_units"),
            count_where(inside & units.isNotNull()).alias(f"{name}_units_rows"),
            stable_sum(F.when(inside, amount)).alias(f"{name}_amount"),
            count_where(inside & amount.isNotNull()).alias(f"{name}_amount_rows"),
        ]
    return parts


def customer_profile(
    tx: DataFrame, as_of: Column | datetime.date | None = None, days: int = RECENT_DAYS
) -> DataFrame:
    """Everything the customer tables need, per meter, account and town, in one scan.

    Rules, depletion and risk features are projections of it; write it once with
    `session.materialize` when several of them are wanted.

    Rows meet by the keys before they are added up: a customer has few rows in a
    town, and a row is a third as wide as the sums that a task would send for it.
    """
    day = as_of_column(tx, as_of)
    amount, units = F.col("purchase_amount"), F.col("electricity_units")
    date = F.to_date("transaction_date")
    return (
        tx.select(*CUSTOMER_KEYS, "transaction_date", "purchase_amount", "electricity_units")
        .repartition(*CUSTOMER_KEYS)
        .groupBy(*CUSTOMER_KEYS)
        .agg(
            F.count("*").alias("transaction_count"),
            F.count(amount).alias("priced_count"),
            stable_sum(amount).alias("total_spent"),
            stable_avg(amount).alias("avg_purchase"),
            F.max(amount).alias("max_purchase"),
            F.min(amount).alias("min_purchase"),
            stable_std(amount).alias("std_purchase"),
            stable_sum(units).alias("total_units"),
            stable_avg(units).alias("avg_units"),
            F.max(units).alias("max_units"),
            stable_std(units).alias("std_units"),
            F.min("transaction_date").alias("first_transaction_time"),
            F.max("transaction_date").alias("last_transaction_time"),
            F.min(date).alias("first_purchase_date"),
            F.max(date).alias("last_transaction_date"),
            *_window_parts(F.date_diff(day, date), days),
        )
        .withColumn(
            "customer_lifetime_days",
            F.date_diff("last_transaction_date", "first_purchase_date") + F.lit(1),
        )
        .withColumn("avg_depletion_interval_days", F.col("customer_lifetime_days") / F.col("transaction_count"))
        .withColumn("inactive_days", F.date_diff(day, "last_transaction_date"))
    )


_RISK_BASE = (
    *CUSTOMER_KEYS,
    "transaction_count",
    "total_spent",
    "avg_purchase",
    "max_purchase",
    "std_purchase",
    "total_units",
    "avg_units",
    "max_units",
    "std_units",
    "first_purchase_date",
    "last_transaction_date",
    "customer_lifetime_days",
    "avg_depletion_interval_days",
    "inactive_days",
)


def risk_base_from(profile: DataFrame) -> DataFrame:
    return profile.select(*_RISK_BASE)


def risk_base(tx: DataFrame, as_of: Column | datetime.date | None = None) -> DataFrame:
    return risk_base_from(customer_profile(tx, as_of))


def _window_averages(parts: DataFrame) -> DataFrame:
    """Per meter: average units, average amount and row count of both windows."""

    def total(name: str) -> Column:
        return stable_sum(F.col(name))

    columns = []
    for name in ("recent", "historical"):
        columns += [
            F.try_divide(total(f"{name}_units"), F.sum(f"{name}_units_rows")).alias(f"{name}_avg_units"),
            F.try_divide(total(f"{name}_amount"), F.sum(f"{name}_amount_rows")).alias(f"{name}_avg_purchase"),
            F.sum(f"{name}_rows").alias(f"{name}_transaction_count"),
        ]
    return parts.groupBy("meter_number").agg(*columns)


def recent_history(
    tx: DataFrame, as_of: Column | datetime.date | None = None, days: int = RECENT_DAYS
) -> DataFrame:
    """Behaviour per meter within `days` of the reference day and before it.

    Both windows come from one pass; an undated row belongs to neither.
    """
    day = as_of_column(tx, as_of)
    age = F.date_diff(day, F.to_date("transaction_date"))
    per_meter = tx.groupBy("meter_number").agg(*_window_parts(age, days))
    return _window_averages(per_meter)


def recent_history_from(profile: DataFrame) -> DataFrame:
    return _window_averages(profile)


def fill_feature_nulls(df: DataFrame) -> DataFrame:
    fill = ["std_purchase", "std_units"]
    for name in ("recent", "historical"):
        fill += [f"{name}_avg_units", f"{name}_avg_purchase", f"{name}_transaction_count"]
    return df.na.fill(0, subset=fill)


def add_ratios(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "consumption_drop_ratio": guarded_ratio(c("recent_avg_units"), c("historical_avg_units")),
            "purchase_spike_ratio": guarded_ratio(c("max_purchase"), c("avg_purchase")),
            "unit_spike_ratio": guarded_ratio(c("max_units"), c("avg_units")),
        }
    )


def risk_features(profile: DataFrame, behaviour: DataFrame | None = None) -> DataFrame:
    """Base features with the recent and historical behaviour of the meter.

    Behaviour is per meter, so a meter seen in two towns carries it on both
    rows, and a NULL meter matches nothing.

    Both sides read the profile, so give a stored one. `behaviour`
    (`recent_history_from`) is stored unless a stored one is given: both join
    inputs are then plain shuffles, which AQE can split when one meter or NULL
    holds a large share.
    """
    if behaviour is None:
        behaviour = materialize(recent_history_from(profile), "behaviour")
    return (
        risk_base_from(profile)
        .join(behaviour, "meter_number", "left")
        .transform(fill_feature_nulls)
        .transform(add_ratios)
    )


def sanitize(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    return df.withColumns({c: finite_or_zero(F.col(c)) for c in cols})


def standardize(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Zero mean, unit population deviation; a constant column becomes 0."""
    moments = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in cols], *[F.stddev_pop(c).alias(f"{c}_std") for c in cols]
    )
    joined = attach_scalars(df, moments)

    def scaled(c: str) -> Column:
        mean, deviation = F.col(f"stats.{c}_mean"), F.col(f"stats.{c}_std")
        # Below that a deviation is the rounding of the mean and the column is constant.
        varies = deviation > F.abs(mean) * 1e-12
        return F.when(varies, (F.col(c) - mean) / deviation).when(F.col(c).isNotNull(), F.lit(0.0))

    return joined.withColumns({c: scaled(c) for c in cols}).drop("stats")


def token_depletion_from(profile: DataFrame) -> DataFrame:
    """Purchase rhythm and how long a purchase lasts."""
    c = F.col
    return (
        profile.select(
            *CUSTOMER_KEYS,
            c("transaction_count").alias("total_purchases"),
            c("total_units").alias("total_units_purchased"),
            c("total_spent").alias("total_amount_paid"),
            c("avg_units").alias("avg_units_per_purchase"),
            c("avg_purchase").alias("avg_purchase_amount"),
            "first_purchase_date",
            c("last_transaction_date").alias("last_purchase_date"),
            "customer_lifetime_days",
        )
        .withColumn("avg_daily_units", c("total_units_purchased") / c("customer_lifetime_days"))
        .withColumn("purchase_frequency_days", c("customer_lifetime_days") / c("total_purchases"))
        .withColumn(
            "estimated_days_to_depletion", F.try_divide(c("avg_units_per_purchase"), c("avg_daily_units"))
        )
    )


def token_depletion(tx: DataFrame) -> DataFrame:
    # The reference day only enters columns that are not selected here.
    return token_depletion_from(customer_profile(tx, F.lit(None).cast("date")))


def meter_activity(tx: DataFrame) -> DataFrame:
    return tx.groupBy("meter_number").agg(F.count("*").alias("txn_count"))


def top_meters(tx: DataFrame, k: int = 1) -> DataFrame:
    return meter_activity(tx).orderBy(F.desc("txn_count"), "meter_number").limit(k)


def meter_daily(tx: DataFrame, k: int | None = 1) -> DataFrame:
    """Units per meter and day: for the k busiest meters, or for all with None."""
    if k is not None:
        chosen = top_meters(tx, k).select("meter_number")
        tx = tx.join(chosen, "meter_number", "left_semi")
    return (
        tx.transform(with_date, out="ds", drop_null=True)
        .groupBy("meter_number", "ds")
        .agg(stable_sum(F.col("electricity_units")).alias("y"))
    )


def for_meter(df: DataFrame, meter) -> DataFrame:
    return df.filter(F.col("meter_number") == meter)
