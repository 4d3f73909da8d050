"""What the physical plans look like, and that skew is split."""

import os
import re

from pyspark.sql import functions as F

from wattline import session
from wattline.operators import clean, features, forecast, gold, risk
from wattline.plans import medallion, queries, revenue
from wattline.session import materialize, new_path
from wattline.sources import files, sinks
from wattline.sources.files import read_table
from wattline.sources.star_schema import transactions


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_monthly_table_reads_three_columns_of_one_table(spark, small):
    text = plan(queries.QUERIES["monthly_revenue"](spark, small))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text
    assert "partial_sum" in text


def test_filters_reach_the_scan(spark, small):
    text = plan(queries.QUERIES["pushed_filter"](spark, small))
    assert "GreaterThan(o_totalprice,100000.0)" in text


def test_duplicates_are_cut_before_the_shuffle(spark, small):
    text = plan(queries.QUERIES["dedup_receipts"](spark, small))
    partial, shuffle, final = (text.index(x) for x in ("1, Partial", "Exchange hashpartitioning(receipt", "1, Final"))
    assert final < shuffle < partial


def test_top_lists_do_not_sort_everything(spark, small):
    for name in ("top_towns_revenue", "top_customers", "top_meters", "top_anomalies", "suspicious_by_rule"):
        text = plan(queries.QUERIES[name](spark, small))
        assert "TakeOrderedAndProject" in text, name
        assert "rangepartitioning" not in text, name


def test_no_query_multiplies_rows(spark, small):
    for name in ("anomaly_rules", "kpi_overview", "scenario_flags", "standardize", "revenue_trend", "recent_history"):
        text = plan(queries.QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_a_message_is_parsed_once(spark, small):
    text = plan(queries.QUERIES["parse_messages"](spark, small))
    assert text.count("from_json(") == 1


def test_profile_is_one_scan_of_the_sales(spark, small):
    profile = features.customer_profile(transactions(spark, small), F.lit("2001-01-01").cast("date"))
    assert len(re.findall(r"FileScan parquet \[l_", plan(profile))) == 1


def test_hot_meter_and_null_meters_are_split(spark):
    """A third of the customers on one meter and a third on none."""
    meter = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    tx = spark.range(0, 60_000, numPartitions=8).select(
        meter.cast("bigint").alias("meter_number"),
        F.concat(F.lit("account"), "id").alias("account_number"),
        F.lit("T").alias("town"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("transaction_date"),
        (F.col("id") % 1000).cast("double").alias("purchase_amount"),
        F.lit(2.0).alias("electricity_units"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        profile = materialize(features.customer_profile(tx))
        behaviour = materialize(features.recent_history_from(profile))
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = features.risk_features(profile, behaviour)
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined)
        expected = features.risk_features(profile)
        assert joined.exceptAll(expected).isEmpty()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_day_is_split_over_files(spark):
    df = spark.range(0, 200_000, numPartitions=4).selectExpr("2024 as year", "if(id % 3 < 2, 1, 2) as month", "id", "uuid() as u")
    keep = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        path = new_path(spark, "months")
        sinks.write_table(sinks.layout(df, by=["year", "month"]), path, partition_by=["year", "month"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
    stored = read_table(spark, path)
    assert stored.count() == 200_000
    files = stored.filter("month = 1").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert "PartitionFilters: [isnotnull(month" in plan(stored.filter("month = 1"))


def test_layout_with_a_file_count(spark):
    df = spark.range(100)
    assert sinks.layout(df, files=3).rdd.getNumPartitions() == 3
    assert sinks.layout(df, files=1).rdd.getNumPartitions() == 1


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "a") != new_path(spark, "a")


def test_csv_to_gold_and_scores(spark, small):
    base = new_path(spark, "lake")
    sinks.write_csv_files(queries.raw_sales(spark, small), f"{base}/csv")
    bronze = medallion.build_bronze(spark, f"{base}/csv", f"{base}/bronze")
    assert {t for _, t in bronze.dtypes} == {"string"}
    silver = medallion.build_silver(spark, f"{base}/bronze", f"{base}/silver")
    expected = queries.raw_sales(spark, small).transform(clean.silver_clean)
    assert silver.count() == expected.count()

    paths = medallion.build_gold(silver, f"{base}/gold")
    stored = {name: read_table(spark, path) for name, path in paths.items()}
    sales = silver.drop("year", "month", "ingestion_timestamp")
    direct = {
        "monthly_revenue": gold.monthly_revenue(sales),
        "town_summary": gold.town_summary(sales),
        "customer_summary": gold.customer_summary(sales),
        "payment_trends": gold.payment_trends(sales),
        "daily_features": gold.daily_features(sales),
        "token_depletion": features.token_depletion(sales),
        "risk_features": revenue.store_features(sales),
        "gold_anomaly_rules": gold.anomaly_rules(gold.fraud_base(sales), gold.as_of_column(sales, None)),
    }
    for name, want in direct.items():
        got = stored[name].select(want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name

    scores = medallion.build_scores(stored["risk_features"], f"{base}/gold", trees=20, sample=64)
    assert scores.count() == stored["risk_features"].count()
    assert not revenue.suspicious_customers(sales, n=5, trees=20, sample=64).isEmpty()
    never = risk.documented_rules(scores).filter("rule_never_bought = 1")
    assert never.count() == scores.filter("total_units = 0 or transaction_count = 0").count()


def test_the_message_route_adds_no_row_without_a_receipt_twice(spark, small):
    sent = queries.sale_messages(spark, small).limit(50)
    none = sent.limit(2).withColumn("transaction_id", F.lit(None).cast(sent.schema["transaction_id"].dataType))
    out = new_path(spark, "silver")
    first = medallion.silver_from_messages(sent.unionByName(none), out).count()
    assert medallion.silver_from_messages(sent.unionByName(none), out).count() == first
    assert read_table(spark, out).where("receipt_number is null").count() == 1


def test_reports_share_one_score_table(spark, small):
    first = queries.stored_rule_scores(spark, small).inputFiles()
    assert queries.stored_rule_scores(spark, small).inputFiles() == first
    plan = queries.QUERIES["score_distribution"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_clean_up_leaves_nothing(spark, small, monkeypatch):
    folder = f"{session.shared_dir(spark)}/one-run"
    monkeypatch.setattr(session, "run_dir", lambda _: folder)
    tables = {t.name for t in spark.catalog.listTables("wattline")} if spark.catalog.databaseExists("wattline") else set()
    for name in ("catalog_table", "csv_scan", "silver_from_messages"):
        queries.QUERIES[name](spark, small).count()
    assert os.listdir(folder)
    session.clean_up(spark)
    assert not os.path.exists(folder)
    assert {t.name for t in spark.catalog.listTables("wattline")} == tables


def test_series_plans_read_the_sales_once(spark, small):
    for name in ("revenue_trend", "filled_series"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[[^\]]*l_shipdate", plan)) == 1, name


def test_cleaning_report_ships_no_struct_of_all_columns(spark, small):
    plan = queries.QUERIES["cleaning_report"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct" not in plan and "WindowGroupLimit" in plan


def test_forecast_tables_are_written(spark, small):
    base = new_path(spark, "forecasts")
    daily = queries.revenue_series(spark, small).filter("series_key in ('all', 'FRANCE')")
    meters = forecast.as_series(features.meter_daily(queries.sales(spark, small), 3), "y", "ds", F.col("meter_number"))
    stored = {n: read_table(spark, p) for n, p in medallion.build_forecasts(daily, meters, base).items()}
    assert stored["unit_forecast"].count() == 3 * forecast.HORIZON
    assert stored["model_comparison"].count() == daily.select("series_key").distinct().count() * 5
    assert {"date", "forecast_revenue", "status"} <= set(stored["revenue_forecast"].columns)


def test_profile_ships_rows_and_not_their_sums(spark, small):
    """The sums of a customer are three times as wide as a sale, and few sales share them."""
    profile = features.customer_profile(queries.branch_sales(spark, small), F.lit("2001-01-01").cast("date"))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange hashpartitioning(meter_number")]
    assert above.count("HashAggregate") == 2, "both halves of the sums lie above the one shuffle by customer"


def test_sales_are_not_moved_by_customer(spark, small):
    """An order looks up its customer before the sales look up their order."""
    text = queries.sales(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= text.index("Join LeftOuter, (l_orderkey") < text.index("Join LeftOuter, (o_custkey")


def test_repeated_and_missing_lookups_multiply_sales(spark, tmp_path):
    """A customer that comes twice gives each of its sales twice; without an order or a customer a sale stays."""
    tables = {
        "lineitem": spark.createDataFrame(
            [(1, 7, 1), (2, 7, 1), (3, 7, 1), (None, 7, 1)], "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT"
        ),
        "orders": spark.createDataFrame([(1, 10), (1, 11), (2, None)], "o_orderkey BIGINT, o_custkey BIGINT"),
        "customer": spark.createDataFrame(
            [(10, "a", 0), (10, "b", 9), (None, "c", 0)], "c_custkey BIGINT, c_name STRING, c_nationkey INT"
        ),
        "nation": spark.createDataFrame([(0, "N"), (0, "M")], "n_nationkey INT, n_name STRING"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    found = transactions(spark, str(tmp_path), ("receipt_number", "meter_number", "account_number", "town"))
    expected = [
        (11, 10, "a", "M"), (11, 10, "a", "N"), (11, 10, "b", None), (11, 11, None, None),
        (21, None, None, None), (31, None, None, None), (None, None, None, None),
    ]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_known_receipts_are_found_without_another_shuffle(spark, tmp_path):
    """The second run leaves rows where the search for duplicates put them, and adds a row without a receipt only once."""
    out = str(tmp_path / "silver")
    sent = queries.sale_messages(spark, "/root/testdata/sf0.001").limit(200)
    named = materialize(sent, "messages")
    unnamed = materialize(sent.limit(1).withColumn("transaction_id", F.lit(None).cast("string")), "unnamed")
    medallion.silver_from_messages(named.limit(100), out)
    wanted = named.select("transaction_id").distinct().count() + 1
    appended = []
    write = medallion.append_table
    medallion.append_table = lambda df, *rest: (appended.append(df), write(df, *rest))
    try:
        assert medallion.silver_from_messages(named.unionByName(unnamed), out).count() == wanted
        assert medallion.silver_from_messages(named.unionByName(unnamed), out).count() == wanted
    finally:
        medallion.append_table = write
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = appended[0].select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_exports_and_stored_steps_are_packed(spark, small, tmp_path):
    raw = queries.raw_sales(spark, small)
    sinks.write_csv_files(raw, f"{tmp_path}/csv")
    names = [n for n in os.listdir(f"{tmp_path}/csv") if n.startswith("part")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    assert files.read_raw_csv(spark, f"{tmp_path}/csv").count() == raw.count()
    sinks.write_csv(raw.limit(3), f"{tmp_path}/report")
    assert any(n.endswith(".csv") for n in os.listdir(f"{tmp_path}/report"))
    sinks.write_table(raw, f"{tmp_path}/table")
    assert any(n.endswith(".zstd.parquet") for n in os.listdir(f"{tmp_path}/table"))
