"""Revenue protection: from transactions to the list of suspicious customers."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators import features, forest, reports, risk
from wattline.session import materialize


def customer_features(tx: DataFrame, as_of: Column | datetime.date | None = None) -> DataFrame:
    """Risk features of all customers over one aggregation of the transactions.

    The profile and the meter behaviour are stored, the join of the two is not.
    """
    profile = materialize(features.customer_profile(tx, as_of), "profile")
    behaviour = materialize(features.recent_history_from(profile), "behaviour")
    return features.risk_features(profile, behaviour)


def store_features(tx: DataFrame, as_of: Column | datetime.date | None = None) -> DataFrame:
    """The same, written to the shared folder for operators that read it several times.

    Quantiles, scaling, the forest and the final projection each take a pass.
    """
    return materialize(customer_features(tx, as_of), "risk-features")


def score_customers(risk_features: DataFrame, **forest_options) -> DataFrame:
    """Forest risk, tiers and scenario flags over stored features."""
    return forest.anomaly_scores(risk_features, **forest_options)


def rule_scores(risk_features: DataFrame, score: str = "max_purchase") -> DataFrame:
    """The same table layout with an existing column as the risk score.

    Needs no model, so its tiers can be checked value by value.
    """
    scored = risk_features.withColumn("risk_score", F.col(score).cast("double"))
    return scored.transform(risk.tiers_and_flags)


def suspicious_customers(
    tx: DataFrame, as_of: Column | datetime.date | None = None, n: int = 50, **forest_options
) -> DataFrame:
    scores = score_customers(store_features(tx, as_of), **forest_options)
    return reports.suspicious_customers(scores, n)
