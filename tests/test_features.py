import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattline.functions.measures import stable_sum
from wattline.operators import features, gold
from wattline.schemas import MODEL_FEATURES
from wattline.session import materialize
from wattline.sources.star_schema import transactions

D = datetime.date
AS_OF = D(2024, 6, 30)


def tx(spark, data):
    """Sales from (meter, account, town, day, amount, units)."""
    df = spark.createDataFrame(
        data,
        "meter_number bigint, account_number string, town string, day date, purchase_amount double, electricity_units double",
    )
    return df.withColumn("transaction_date", F.col("day").cast("timestamp")).drop("day")


def risk(spark, data, as_of=AS_OF):
    return features.risk_features(materialize(features.customer_profile(tx(spark, data), as_of)))


def test_meter_in_two_towns_shares_its_behaviour(spark):
    got = risk(
        spark,
        [
            (1, "a", "A", D(2024, 6, 20), 10.0, 2.0),
            (1, "a", "B", D(2024, 6, 25), 30.0, 4.0),
            (1, "a", "B", D(2024, 1, 1), 50.0, 6.0),
        ],
    ).select("town", "recent_avg_units", "recent_avg_purchase", "recent_transaction_count", "historical_avg_units", "historical_transaction_count")
    assert rows(got, "town") == [("A", 3.0, 20.0, 2, 6.0, 1), ("B", 3.0, 20.0, 2, 6.0, 1)]


def test_null_meter_matches_nothing(spark):
    got = risk(spark, [(None, "a", "A", D(2024, 6, 20), 10.0, 2.0), (None, "b", "A", D(2024, 1, 20), 10.0, 2.0)])
    for r in got.collect():
        assert (r.recent_avg_units, r.recent_transaction_count, r.historical_avg_units, r.historical_transaction_count) == (0, 0, 0, 0)
        assert r.consumption_drop_ratio == 1


def test_lapsed_and_new_customers(spark):
    got = risk(spark, [(1, "a", "A", D(2023, 6, 1), 10.0, 2.0), (2, "b", "A", D(2024, 6, 29), 10.0, 2.0)])
    ratios = {r.meter_number: r.consumption_drop_ratio for r in got.collect()}
    assert ratios == {1: 0.0, 2: 1.0}


def test_window_boundary(spark):
    data = [
        (1, "a", "A", D(2024, 5, 31), 1.0, 1.0),  # 30 days
        (1, "a", "A", D(2024, 5, 30), 1.0, 1.0),  # 31 days
        (1, "a", "A", None, 1.0, 1.0),
    ]
    got = rows(features.recent_history(tx(spark, data), AS_OF).select("recent_transaction_count", "historical_transaction_count"))
    assert got == [(1, 1)]


def test_default_day_is_the_last_in_the_data(spark):
    data = [(1, "a", "A", D(2024, 3, 1), 1.0, 1.0), (2, "b", "A", D(2024, 3, 11), 1.0, 1.0)]
    got = {r.meter_number: r.inactive_days for r in features.risk_base(tx(spark, data)).collect()}
    assert got == {1: 10, 2: 0}


def test_single_purchase(spark):
    data = [(1, "a", "A", D(2024, 6, 1), 10.0, 2.0)]
    assert gold.fraud_base(tx(spark, data)).first().std_purchase is None
    got = risk(spark, data).first()
    assert (got.std_purchase, got.std_units, got.customer_lifetime_days, got.avg_depletion_interval_days) == (0, 0, 1, 1)


def test_null_amounts_count_as_rows_but_not_in_averages(spark):
    data = [(1, "a", "A", D(2024, 6, 1), 10.0, 2.0), (1, "a", "A", D(2024, 6, 2), None, None)]
    got = features.risk_base(tx(spark, data), AS_OF).first()
    assert (got.transaction_count, got.avg_purchase, got.avg_units) == (2, 10.0, 2.0)


def test_depletion_with_no_units(spark):
    data = [(1, "a", "A", D(2024, 6, 1), 10.0, 0.0), (2, "b", "A", D(2024, 6, 1), 10.0, 3.0), (2, "b", "A", D(2024, 6, 4), 10.0, 5.0)]
    got = features.token_depletion(tx(spark, data)).select(
        "meter_number", "avg_daily_units", "purchase_frequency_days", "estimated_days_to_depletion"
    )
    assert rows(got, "meter_number") == [(1, 0.0, 1.0, None), (2, 2.0, 2.0, 2.0)]


def test_sanitize_and_standardize(spark):
    df = spark.createDataFrame(
        [(float("nan"), 5.0), (float("inf"), 5.0), (3.0, 5.0), (None, 5.0), (-float("inf"), 5.0)], "a double, b double"
    )
    clean = features.sanitize(df, ["a", "b"])
    assert [r.a for r in clean.collect()] == [0, 0, 3, 0, 0]
    scaled = features.standardize(clean, ["a", "b"])
    check = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.max("b"), F.min("b")).first()
    assert list(check) == pytest.approx([0, 1, 0, 0], abs=1e-12)


def test_recent_and_historical_split_all_dated_rows(spark, small):
    sales = transactions(spark, small)
    got = features.recent_history(sales).agg(
        F.sum("recent_transaction_count") + F.sum("historical_transaction_count")
    )
    assert got.first()[0] == sales.filter("transaction_date is not null").count()


def test_revenue_is_the_same_by_every_key(spark, small):
    sales = transactions(spark, small)
    totals = [
        gold.monthly_revenue(sales).agg(F.round(F.sum("total_revenue"), 2)),
        gold.town_summary(sales).agg(F.round(F.sum("total_revenue"), 2)),
        gold.customer_summary(sales).agg(F.round(F.sum("customer_total_spent"), 2)),
        gold.payment_trends(sales).agg(F.round(F.sum("monthly_town_revenue"), 2)),
        gold.daily_features(sales).agg(F.round(F.sum("daily_revenue"), 2)),
    ]
    assert len({t.first()[0] for t in totals}) == 1


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rollups_equal_direct_tables(spark, small):
    sales = transactions(spark, small)
    by_day = materialize(gold.daily_town(sales))
    for build in (gold.monthly_revenue, gold.town_summary, gold.payment_trends, gold.daily_features):
        same(build(sales), build(by_day))
    profile = materialize(features.customer_profile(sales))
    same(gold.customer_summary(sales), gold.customer_summary_from(profile))
    same(gold.fraud_base(sales), gold.fraud_base_from(profile))
    same(features.recent_history(sales), features.recent_history_from(profile))
    same(features.token_depletion(sales), features.token_depletion_from(profile))


def test_results_do_not_depend_on_row_order(spark, small):
    sales = transactions(spark, small)
    same(features.customer_profile(sales.repartition(1)), features.customer_profile(sales.repartition(23)))


def test_undated_sales_make_a_month_of_their_own(spark):
    data = [(1, "a", "A", None, 10.0, 1.0), (1, "a", "A", D(2024, 6, 2), 5.0, 1.0)]
    monthly = gold.monthly_revenue(tx(spark, data))
    assert rows(monthly.select("year", "month", "total_revenue"), "year") == [(None, None, 10.0), (2024, 6, 5.0)]
    assert gold.daily_features(tx(spark, data)).count() == 1


def test_top_meters_and_all_meters(spark):
    data = [(m, "a", "A", D(2024, 6, d), 1.0, 1.0) for m, n in ((1, 2), (2, 3), (3, 3)) for d in range(1, n + 1)]
    sales = tx(spark, data)
    assert rows(features.top_meters(sales, 2)) == [(2, 3), (3, 3)]
    assert features.meter_daily(sales, 1).select("meter_number").distinct().collect()[0][0] == 2
    assert features.meter_daily(sales, None).count() == 8
    assert features.for_meter(features.meter_daily(sales, None), 3).count() == 3


def test_model_features_are_all_there(spark):
    got = risk(spark, [(1, "a", "A", D(2024, 6, 1), 10.0, 2.0)])
    assert set(MODEL_FEATURES) <= set(got.columns)


def test_sums_do_not_depend_on_the_order(spark):
    """Totals far above the digits of a double, added up in different orders."""
    amount = F.lit(8_000_000.0) + F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1000.0 + F.lit(0.0001)
    df = spark.range(3_000_000).select(amount.alias("x"))
    found = {df.repartition(n).agg(stable_sum(F.col("x"))).first()[0] for n in (1, 3, 7, 11)}
    assert len(found) == 1
    exact = df.agg(F.sum(F.col("x").cast("decimal(20,4)"))).first()[0]
    assert found == {float(exact)}


def test_sums_of_awkward_values(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(stable_sum(F.col("x"))).first()[0]

    assert total() is None and total(None) is None
    assert total(None, 0.1, 0.2) == 0.3
    assert total(-1.5, 1.25) == -0.25 and total(0.00000001, 0.00000002) == 3e-8
    assert total(float("inf"), 1.0) == float("inf") and total(1e300, 2.0) == 1e300 + 2
    assert total(float("nan"), 1.0) != total(float("nan"), 1.0)
