"""Report queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.measures import count_where, stable_sum
from wattline.functions.quantiles import attach_scalars
from wattline.schemas import CUSTOMER_KEYS, SCENARIO_FLAGS


def anomalies(df: DataFrame) -> DataFrame:
    return df.filter(F.col("anomaly_score") > 0)


def named_towns(df: DataFrame) -> DataFrame:
    return df.filter(F.col("town").isNotNull() & (F.col("town") != "NULL"))


def with_period(monthly: DataFrame) -> DataFrame:
    """First day of each month; months without a date are left out."""
    return monthly.dropna(subset=["year", "month"]).withColumn(
        "period", F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    )


def complete_periods(df: DataFrame) -> DataFrame:
    """Without the latest period, which is still filling up.

    A table of periods has a row for each, so the maximum over all of them is a small window and no second pass.
    """
    latest = F.max("period").over(Window.partitionBy())
    return df.withColumn("_latest", latest).filter(F.col("period") != F.col("_latest")).drop("_latest")


def revenue_trend(monthly: DataFrame) -> DataFrame:
    return monthly.transform(with_period).transform(complete_periods).orderBy("period")


def anomaly_summary(scores: DataFrame) -> DataFrame:
    """Per score: its customers, next to the overall count and the anomaly cases.

    The overall figures add up the few groups instead of reading the scores again.
    """
    groups = scores.groupBy("anomaly_score").agg(F.count("*").alias("customers"))
    totals = groups.agg(
        F.sum("customers").alias("total_records"),
        F.sum(F.when(F.col("anomaly_score") > 0, F.col("customers")).otherwise(0)).alias("anomaly_cases"),
    )
    return attach_scalars(groups, totals).select(
        "anomaly_score", "customers", F.col("stats.total_records"), F.col("stats.anomaly_cases")
    )


def kpi_overview(monthly: DataFrame, scores: DataFrame) -> DataFrame:
    """Headline figures; months without a date count towards the totals."""
    risky = F.col("anomaly_score") > 0
    totals = monthly.agg(
        stable_sum(F.col("total_revenue")).alias("total_revenue"),
        F.sum("total_transactions").alias("total_transactions"),
        stable_sum(F.col("total_units_sold")).alias("total_units"),
    )
    risk = scores.agg(
        count_where(risky).alias("anomaly_cases"),
        count_where(F.col("anomaly_score") == 2).alias("high_risk_cases"),
        F.coalesce(stable_sum(F.when(risky, F.col("total_spent"))), F.lit(0.0)).alias("revenue_at_risk"),
    )
    return attach_scalars(totals, risk).select("*", "stats.*").drop("stats")


def high_risk_count(scores: DataFrame) -> DataFrame:
    return scores.agg(count_where(F.col("anomaly_score") == 2).alias("high_risk_cases"))


def score_distribution(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("anomaly_score").isNotNull()).groupBy("anomaly_score").agg(F.count("*").alias("count"))


def scenario_counts(scores: DataFrame) -> DataFrame:
    """How many customers trip each scenario flag that the table has."""
    present = [c for c in SCENARIO_FLAGS if c in scores.columns]
    sums = scores.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in present])
    return sums.unpivot([], present, "scenario", "count")


def anomalies_by_town(scores: DataFrame, n: int | None = None) -> DataFrame:
    """Suspicious customers per town; `n` keeps the leading towns."""
    counts = (
        anomalies(scores)
        .filter(F.col("town").isNotNull())
        .groupBy("town")
        .agg(F.count("*").alias("fraud_cases"))
    )
    return counts if n is None else counts.orderBy(F.desc("fraud_cases"), "town").limit(n)


def payment_ranking(trends: DataFrame, n: int = 15) -> DataFrame:
    """Leading towns by payments; the text NULL counts as a town here."""
    return (
        trends.filter(F.col("town").isNotNull())
        .groupBy("town")
        .agg(
            stable_sum(F.col("monthly_town_revenue")).alias("monthly_town_revenue"),
            F.sum("monthly_town_transactions").alias("monthly_town_transactions"),
        )
        .orderBy(F.desc("monthly_town_revenue"), "town")
        .limit(n)
    )


def top_towns_revenue(towns: DataFrame, n: int = 20) -> DataFrame:
    return named_towns(towns).orderBy(F.desc("total_revenue"), "town").limit(n)


def top_towns_units(towns: DataFrame, n: int = 15) -> DataFrame:
    return named_towns(towns).orderBy(F.desc("total_units_sold"), "town").limit(n)


def top_customers(customers: DataFrame, n: int = 20) -> DataFrame:
    return customers.orderBy(F.desc("customer_total_spent"), "meter_number", "account_number").limit(n)


def top_anomalies(scores: DataFrame, n: int = 100) -> DataFrame:
    return anomalies(scores).orderBy(F.desc("anomaly_score"), *CUSTOMER_KEYS).limit(n)


def suspicious_customers(scores: DataFrame, n: int = 50) -> DataFrame:
    return (
        anomalies(scores)
        .select(
            *CUSTOMER_KEYS,
            "risk_score",
            "anomaly_score",
            "fraud_scenario_score",
            "transaction_count",
            "total_spent",
            "max_purchase",
            "sudden_consumption_drop_flag",
            "purchase_spike_flag",
            "inactive_customer_flag",
        )
        .orderBy(F.desc("risk_score"), *CUSTOMER_KEYS)
        .limit(n)
    )


def ingest_progress(df: DataFrame, target: int = 43_000_000, elapsed_minutes: float = 10) -> DataFrame:
    """Rows loaded, share of the target, rows to go and minutes left at this rate."""
    rows = F.col("rows_ingested")
    return df.agg(F.count("*").alias("rows_ingested")).select(
        rows,
        (rows / F.lit(float(target)) * 100).alias("progress_pct"),
        (F.lit(target).cast("bigint") - rows).alias("remaining"),
        F.when(rows > 10, (target - rows) / (rows / F.lit(float(elapsed_minutes))))
        .otherwise(F.lit(0.0))
        .alias("eta_minutes"),
    )


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("live_alerts"))
