"""Rules, flags, tiers and the transaction score."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.measures import flag
from wattline.functions.quantiles import attach_scalars, exact_quantiles
from wattline.schemas import SCENARIO_FLAGS


#: Quantiles that the scenario flags and the tiers compare with: name -> (column, share).
SCENARIO_LIMITS = {
    "volume": ("max_purchase", 0.95),
    "frequent": ("transaction_count", 0.95),
    "interval": ("avg_depletion_interval_days", 0.05),
    "variable": ("std_purchase", 0.95),
}
TIER_SHARES = {"p90": 0.90, "p98": 0.98}


def with_flags(df: DataFrame) -> DataFrame:
    """The eight flags, their sum, and the older name of the first, by the limits in the struct `stats`."""
    c = F.col
    flags = {
        "irregular_vending_volume_flag": c("max_purchase") >= c("stats.volume"),
        "frequent_transaction_flag": c("transaction_count") >= c("stats.frequent"),
        "unusual_depletion_interval_flag": c("avg_depletion_interval_days") <= c("stats.interval"),
        "sudden_consumption_drop_flag": c("consumption_drop_ratio") < 0.30,
        "purchase_spike_flag": c("purchase_spike_ratio") >= 3,
        "unit_spike_flag": c("unit_spike_ratio") >= 3,
        "inactive_customer_flag": c("inactive_days") > 90,
        "high_variability_flag": c("std_purchase") >= c("stats.variable"),
    }
    total = sum((c(name) for name in SCENARIO_FLAGS[1:]), c(SCENARIO_FLAGS[0]))
    return (
        df.withColumns({name: flag(rule) for name, rule in flags.items()})
        .withColumn("high_value_flag", c("irregular_vending_volume_flag"))
        .withColumn("fraud_scenario_score", total)
    )


def tier(score: Column) -> Column:
    """2 in the top 2 % of risk, 1 in the top 10 %, else 0, by the cuts in the struct `stats`."""
    return F.when(score >= F.col("stats.p98"), 2).when(score >= F.col("stats.p90"), 1).otherwise(0)


def scenario_flags(features: DataFrame) -> DataFrame:
    """The eight explainable flags, their sum, and the older name of the first.

    The four quantile limits are exact and come from one extra pass over
    `features`, so give a stored frame.
    """
    return attach_scalars(features, exact_quantiles(features, SCENARIO_LIMITS)).transform(with_flags).drop("stats")


def risk_tiers(scored: DataFrame, score: str = "risk_score") -> DataFrame:
    """`anomaly_score`: 2 in the top 2 % of risk, 1 in the top 10 %, else 0."""
    cuts = exact_quantiles(scored, {name: (score, share) for name, share in TIER_SHARES.items()})
    return attach_scalars(scored, cuts).withColumn("anomaly_score", tier(F.col(score))).drop("stats")


def tiers_and_flags(scored: DataFrame, score: str = "risk_score") -> DataFrame:
    """Both of the above with all six quantiles from the same passes."""
    wanted = {name: (score, share) for name, share in TIER_SHARES.items()} | SCENARIO_LIMITS
    both = attach_scalars(scored, exact_quantiles(scored, wanted))
    return both.withColumn("anomaly_score", tier(F.col(score))).transform(with_flags).drop("stats")


def documented_rules(features: DataFrame) -> DataFrame:
    """The three documented customer rules.

    The documents leave the recent window open; it is that of the features, 30 days.
    """
    c = F.col
    return features.withColumns(
        {
            "rule_never_bought": flag((c("total_units") == 0) | (c("transaction_count") == 0)),
            "rule_sharp_decline": flag(c("recent_avg_units") < 0.5 * c("historical_avg_units")),
            "rule_inactive_6months": flag(c("inactive_days") > 180),
        }
    )


def risk_category(df: DataFrame, score: Column | str) -> DataFrame:
    s = F.col(score) if isinstance(score, str) else score
    return df.withColumn("risk_category", F.when(s > 0.7, "HIGH").when(s > 0.4, "MEDIUM").otherwise("LOW"))


def _next_purchase(amount: Column, factor: str) -> Column:
    # Decimal arithmetic, so that half a cent always rounds up; amounts beyond
    # its range have no cents left to round.
    exact = F.round(amount.try_cast("decimal(24,6)") * F.lit(Decimal(factor)), 2).cast("double")
    return F.coalesce(exact, F.round(amount * F.lit(float(factor)), 2))


def score_risk(df: DataFrame) -> DataFrame:
    """Risk level, score and expected next purchase of each scoring record."""
    c = F.col
    amount, units = c("purchase_amount"), c("electricity_units")
    owed = F.coalesce(c("outstanding_amount"), F.lit(0.0)) if "outstanding_amount" in df.columns else F.lit(0.0)
    level = (
        F.when(amount.isNull() | units.isNull(), F.lit(None).cast("string"))
        .when((owed > 50000) | (amount < 1000) | (units < 2), "HIGH")
        .when((owed > 10000) | (amount < 3000), "MEDIUM")
        .otherwise("LOW")
    )
    return df.withColumn("risk_level", level).withColumns(
        {
            "risk_score": F.when(c("risk_level") == "HIGH", 0.85)
            .when(c("risk_level") == "MEDIUM", 0.55)
            .when(c("risk_level") == "LOW", 0.15),
            "predicted_next_purchase": F.when(c("risk_level") == "LOW", _next_purchase(amount, "1.08")).when(
                c("risk_level").isNotNull(), _next_purchase(amount, "0.85")
            ),
            "prediction_time": F.current_timestamp(),
        }
    )


def high_value_alerts(df: DataFrame, threshold: float = 100000, n: int | None = 50) -> DataFrame:
    """Largest purchases above the threshold; `n=None` keeps them all."""
    amount = F.col("purchase_amount").try_cast("double")
    alerts = (
        df.filter(amount > threshold)
        .select(
            "meter_number",
            "account_number",
            "town",
            amount.alias("purchase_amount"),
            F.col("electricity_units").try_cast("double").alias("electricity_units"),
        )
    )
    if n is None:
        return alerts
    return alerts.orderBy(
        F.desc("purchase_amount"), "meter_number", "account_number", "town", "electricity_units"
    ).limit(n)
