import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattline.operators import gold, reports, risk
from wattline.schemas import SCENARIO_FLAGS

FEATURES = (
    "meter_number bigint, account_number string, town string, max_purchase double, transaction_count bigint, "
    "avg_depletion_interval_days double, std_purchase double, consumption_drop_ratio double, "
    "purchase_spike_ratio double, unit_spike_ratio double, inactive_days int, total_units double, "
    "recent_avg_units double, historical_avg_units double, total_spent double"
)


def feature(**changes):
    row = dict(
        meter_number=1, account_number="a", town="A", max_purchase=10.0, transaction_count=5,
        avg_depletion_interval_days=3.0, std_purchase=1.0, consumption_drop_ratio=1.0, purchase_spike_ratio=1.0,
        unit_spike_ratio=1.0, inactive_days=0, total_units=5.0, recent_avg_units=1.0, historical_avg_units=1.0,
        total_spent=7.0,
    )
    row.update(changes)
    return tuple(row.values())


def frame(spark, *data):
    return spark.createDataFrame(list(data), FEATURES)


BASE = "meter_number bigint, account_number string, town string, transaction_count bigint, max_purchase double, last_transaction_date timestamp"


def test_inactive_flag_is_not_in_the_gold_score(spark):
    base = spark.createDataFrame([(1, "a", "A", 1, 5.0, datetime.datetime(2023, 1, 1))], BASE)
    got = gold.anomaly_rules(base, datetime.date(2024, 2, 5)).first()
    assert (got.inactive_customer_flag, got.anomaly_score) == (1, 0)


def test_gold_limits_are_strict(spark):
    day = datetime.datetime(2024, 1, 1)
    base = spark.createDataFrame([(i, "a", "A", 7, 100000.0, day) for i in range(20)], BASE)
    got = gold.anomaly_rules(base, datetime.date(2024, 3, 31)).agg(
        F.sum("high_value_flag"), F.sum("frequent_transaction_flag"), F.sum("inactive_customer_flag")
    )
    assert rows(got) == [(0, 0, 0)]  # equal counts, amount at the limit, exactly 90 days
    later = gold.anomaly_rules(base, datetime.date(2024, 4, 1), exact=False)
    assert later.agg(F.sum("inactive_customer_flag")).first()[0] == 20


def test_ties_are_all_flagged_by_quantile_rules(spark):
    got = risk.scenario_flags(frame(spark, *[feature(meter_number=i) for i in range(20)]))
    counts = {r.scenario: r["count"] for r in reports.scenario_counts(got).collect()}
    assert counts == {
        **dict.fromkeys(SCENARIO_FLAGS, 0),
        "irregular_vending_volume_flag": 20,
        "frequent_transaction_flag": 20,
        "unusual_depletion_interval_flag": 20,
        "high_variability_flag": 20,
    }
    assert {r.fraud_scenario_score for r in got.collect()} == {4}


@pytest.mark.parametrize(
    "changes, name, value",
    [
        (dict(consumption_drop_ratio=0.29), "sudden_consumption_drop_flag", 1),
        (dict(consumption_drop_ratio=0.30), "sudden_consumption_drop_flag", 0),
        (dict(purchase_spike_ratio=3.0), "purchase_spike_flag", 1),
        (dict(unit_spike_ratio=2.99), "unit_spike_flag", 0),
        (dict(inactive_days=91), "inactive_customer_flag", 1),
        (dict(inactive_days=90), "inactive_customer_flag", 0),
    ],
)
def test_fixed_limits(spark, changes, name, value):
    assert risk.scenario_flags(frame(spark, feature(**changes))).first()[name] == value


def test_tiers(spark):
    df = spark.range(1, 101).selectExpr("cast(id as double) as risk_score")
    got = rows(reports.score_distribution(risk.risk_tiers(df)), "anomaly_score")
    assert got == [(0, 90), (1, 8), (2, 2)]


def test_tiers_skip_missing_scores(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "risk_score double")
    assert rows(risk.risk_tiers(df), "risk_score") == [(None, 0), (1.0, 0), (2.0, 2)]


@pytest.mark.parametrize(
    "amount, units, owed, level",
    [
        (999.99, 5.0, 0.0, "HIGH"),
        (1000.0, 5.0, 0.0, "MEDIUM"),
        (2999.99, 5.0, 0.0, "MEDIUM"),
        (3000.0, 5.0, 0.0, "LOW"),
        (5000.0, 1.9, 0.0, "HIGH"),
        (5000.0, 2.0, 0.0, "LOW"),
        (5000.0, 5.0, 10000.0, "LOW"),
        (5000.0, 5.0, 10000.01, "MEDIUM"),
        (5000.0, 5.0, 50000.0, "MEDIUM"),
        (5000.0, 5.0, 50000.01, "HIGH"),
        (5000.0, 5.0, None, "LOW"),
        (None, 5.0, 0.0, None),
    ],
)
def test_transaction_levels(spark, amount, units, owed, level):
    df = spark.createDataFrame([(amount, units, owed)], "purchase_amount double, electricity_units double, outstanding_amount double")
    got = risk.score_risk(df).first()
    assert got.risk_level == level
    assert got.risk_score == {"HIGH": 0.85, "MEDIUM": 0.55, "LOW": 0.15, None: None}[level]
    if amount is None:
        assert got.predicted_next_purchase is None
    else:
        assert got.predicted_next_purchase == pytest.approx(amount * (1.08 if level == "LOW" else 0.85), abs=0.0051)


def test_debt_may_be_missing_altogether(spark):
    df = spark.createDataFrame([(5000.0, 5.0)], "purchase_amount double, electricity_units double")
    got = risk.score_risk(df).first()
    assert (got.risk_level, got.predicted_next_purchase) == ("LOW", 5400.0)


def test_documented_rules(spark):
    df = frame(
        spark,
        feature(meter_number=1, total_units=0.0),
        feature(meter_number=2, recent_avg_units=0.49),
        feature(meter_number=3, recent_avg_units=0.5, inactive_days=181),
        feature(meter_number=4, inactive_days=180),
    )
    got = risk.documented_rules(df).select("rule_never_bought", "rule_sharp_decline", "rule_inactive_6months")
    assert rows(got) == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    scores = spark.createDataFrame([(0.71,), (0.7,), (0.41,), (0.4,)], "s double")
    assert [r.risk_category for r in risk.risk_category(scores, "s").collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]


TOWNS = "town string, total_revenue double, total_units_sold double"


def test_town_labels(spark):
    towns = spark.createDataFrame([(None, 9.0, 9.0), ("NULL", 8.0, 8.0), ("MJINI", 1.0, 1.0)], TOWNS)
    assert [r.town for r in reports.top_towns_revenue(towns).collect()] == ["MJINI"]
    assert [r.town for r in reports.top_towns_units(towns).collect()] == ["MJINI"]
    trends = spark.createDataFrame(
        [(None, 9.0, 1), ("NULL", 8.0, 2), ("MJINI", 1.0, 3), ("MJINI", 1.0, 4)],
        "town string, monthly_town_revenue double, monthly_town_transactions bigint",
    )
    assert rows(reports.payment_ranking(trends)) == [("NULL", 8.0, 2), ("MJINI", 2.0, 7)]


MONTHLY = "year int, month int, total_revenue double, total_units_sold double, total_transactions bigint"


def test_undated_months_count_in_the_kpis_only(spark):
    monthly = spark.createDataFrame([(None, None, 10.0, 1.0, 1), (2024, 1, 5.0, 1.0, 1), (2024, 2, 6.0, 1.0, 1)], MONTHLY)
    scores = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 4.0)], "anomaly_score int, total_spent double")
    kpi = reports.kpi_overview(monthly, scores).first()
    assert (kpi.total_revenue, kpi.total_transactions, kpi.anomaly_cases, kpi.high_risk_cases, kpi.revenue_at_risk) == (21.0, 3, 2, 1, 6.0)
    assert [r.period for r in reports.revenue_trend(monthly).collect()] == [datetime.date(2024, 1, 1)]


def test_reports_over_nothing(spark):
    scores = spark.createDataFrame([], "anomaly_score int, total_spent double")
    monthly = spark.createDataFrame([], MONTHLY)
    assert reports.kpi_overview(monthly, scores).first().anomaly_cases == 0
    assert reports.revenue_trend(monthly).count() == 0
    assert reports.anomaly_summary(scores).count() == 0
    assert rows(reports.ingest_progress(scores)) == [(0, 0.0, 43_000_000, 0.0)]


def test_scenario_counts_take_what_is_there(spark):
    df = spark.createDataFrame([(1, 0), (1, 1)], "purchase_spike_flag int, unit_spike_flag int")
    assert rows(reports.scenario_counts(df), "scenario") == [("purchase_spike_flag", 2), ("unit_spike_flag", 1)]


def test_progress(spark):
    got = reports.ingest_progress(spark.range(100), target=1000, elapsed_minutes=5).first()
    assert (got.progress_pct, got.remaining, got.eta_minutes) == (10.0, 900, 45.0)


def test_alerts_take_text_amounts(spark):
    df = spark.createDataFrame(
        [(1, "a", "A", "100000.01", "3"), (2, "b", "A", "100000", "3"), (3, "c", "A", "oops", "3"), (4, "d", "A", "200000", "x")],
        "meter_number int, account_number string, town string, purchase_amount string, electricity_units string",
    )
    assert [r.meter_number for r in risk.high_value_alerts(df).collect()] == [4, 1]
    assert reports.alert_count(risk.high_value_alerts(df, n=1)).first()[0] == 1
