"""The registered queries: one per operator, over the whole tables of a folder.

Dates and times leave as text so that both engines print them alike. Columns
that hold a clock or a random id are dropped from the results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators import clean, features, forecast, forest, gold, messages, reports, risk
from wattline.plans import medallion, revenue
from wattline.session import materialize, new_path
from wattline.sources import broker, files, sinks
from wattline.sources.star_schema import event_transactions, latest_date, transactions
from wattline.streaming import ingest, live

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

_RISK_COLUMNS = ("transaction_date", "meter_number", "account_number", "town", "purchase_amount", "electricity_units")


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return dates_as_text(build(spark, folder))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


def dates_as_text(df: DataFrame) -> DataFrame:
    shown = {}
    for name, kind in df.dtypes:
        if kind == "date":
            shown[name] = F.date_format(name, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            shown[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumns(shown) if shown else df


# --- inputs ---------------------------------------------------------------


def sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return transactions(spark, folder, columns or None)


def branch_sales(spark: SparkSession, folder: str, columns: Iterable[str] = _RISK_COLUMNS) -> DataFrame:
    """Sales whose town is that of the vendor: one meter, several towns."""
    return transactions(spark, folder, columns, town="supplier")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as a dirty text export: bad numbers and dates, padding, other spellings."""
    tx = transactions(spark, folder)
    c = F.col
    receipt, vendor = c("receipt_number"), c("vendor_id")
    stamp = lambda name: F.date_format(name, "yyyy-MM-dd HH:mm:ss")
    text = lambda name: c(name).cast("string")
    return tx.select(
        F.when(receipt % 19 == 0, "xx").otherwise(stamp("transaction_date")).alias("transaction_date"),
        F.when(vendor % 23 == 0, "n/a").otherwise(F.concat(F.lit(" "), text("vendor_id"))).alias("vendor_id"),
        F.concat(text("meter_number"), F.lit(".0")).alias("meter_number"),
        F.concat(F.lit("  "), c("account_number"), F.lit(" ")).alias("account_number"),
        F.when(receipt % 17 == 0, "bad").otherwise(text("receipt_number")).alias("receipt_number"),
        F.when(vendor % 13 == 0, "abc").otherwise(text("purchase_amount")).alias("purchase_amount"),
        F.when(receipt % 11 == 0, "").otherwise(text("electricity_units")).alias("electricity_units"),
        c("tax_amount").cast("decimal(18,4)").cast("string").alias("Tax_amount"),
        text("tariff_charge").alias("tariff_charge"),
        text("fixed_charge").alias("fixed_charge"),
        text("arrears_paid").alias("arrears_paid"),
        F.concat(F.lit(" "), F.lower("consumer_surname")).alias("consumer_surname"),
        F.concat(F.lower("consumer_first_name"), F.lit(" ")).alias("consumer_first_name"),
        stamp("customer_connectdate").alias("customer_connectedate"),
        F.concat(c("vending_category"), F.lit(" ")).alias("vending_category"),
        F.concat(F.lit(" "), F.lower("town"), F.lit("  ")).alias("town"),
        text("outstanding_amount").alias("outstanding_amount"),
    )


def signed_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with reversals, zero and missing amounts and zero units among them."""
    tx = transactions(spark, folder)
    receipt, vendor, amount = F.col("receipt_number"), F.col("vendor_id"), F.col("purchase_amount")
    return tx.withColumns(
        {
            "purchase_amount": F.when(receipt % 13 == 0, -amount)
            .when(receipt % 29 == 0, F.lit(0.0))
            .when(vendor % 31 == 0, F.lit(None).cast("double"))
            .otherwise(amount),
            "electricity_units": F.when(receipt % 7 == 0, F.lit(0.0)).otherwise(F.col("electricity_units")),
        }
    )


def sale_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Sales under the message column names."""
    c = F.col
    return transactions(
        spark,
        folder,
        ("receipt_number", "meter_number", "purchase_amount", "electricity_units", "vendor_id",
         "transaction_date", "vending_category", "account_number", "town"),
    ).select(
        c("receipt_number").cast("string").alias("transaction_id"),
        c("meter_number").cast("string").alias("meter_id"),
        F.concat(F.lit("T"), c("receipt_number").cast("string")).alias("token_id"),
        "purchase_amount",
        c("electricity_units").alias("units_purchased"),
        c("vendor_id").cast("string").alias("vendor_id"),
        F.concat(F.lit("VP_"), c("vendor_id").cast("string")).alias("vending_point_id"),
        "transaction_date",
        c("vending_category").alias("payment_method"),
        c("account_number").alias("customer_id"),
        c("town").alias("region"),
    )


def loose_export(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as a partner's export: other column names, gaps and garbage."""
    c = F.col
    tx = transactions(
        spark, folder, ("receipt_number", "meter_number", "purchase_amount", "electricity_units",
                        "vendor_id", "transaction_date", "vending_category")
    )
    receipt, vendor = c("receipt_number"), c("vendor_id")
    return tx.select(
        receipt.alias("row_id"),
        F.when(receipt % 5 != 0, F.concat(F.lit("R"), receipt.cast("string"))).alias("transaction_id"),
        F.when(vendor % 6 != 0, c("meter_number").cast("string")).otherwise("").alias("meter_id"),
        F.when(receipt % 3 == 0, c("purchase_amount").cast("string")).alias("purchase_amount"),
        F.when(receipt % 7 == 0, "free").otherwise((c("purchase_amount") / 2).cast("string")).alias("amount"),
        F.when(receipt % 11 != 0, c("electricity_units").cast("string")).alias("units"),
        F.when(vendor % 4 != 0, vendor.cast("string")).alias("vendor_id"),
        F.when(vendor % 3 != 0, F.concat(F.lit("P"), vendor.cast("string"))).alias("vending_point"),
        F.when(receipt % 9 == 0, "soon").otherwise(F.date_format("transaction_date", "yyyy-MM-dd")).alias("date"),
        F.when(vendor % 10 != 0, c("vending_category")).alias("payment_method"),
    )


def live_events(spark: SparkSession, folder: str) -> DataFrame:
    return event_transactions(spark.read.parquet(f"{folder}/events.parquet"))


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Customer profile as of the last selling day."""
    return features.customer_profile(branch_sales(spark, folder), latest_date(spark, folder))


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.customer_features(branch_sales(spark, folder), latest_date(spark, folder))


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.store_features(branch_sales(spark, folder), latest_date(spark, folder))


#: Where the scores of a folder's customers lie, by application and folder.
_SCORE_TABLES: dict[tuple[str, str], str] = {}


def stored_rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The one score table of a folder that the reports read, as `build_scores` leaves one; written by the first of them."""
    key = (spark.sparkContext.applicationId, folder)
    path = _SCORE_TABLES.get(key)
    if path is None or not files.exists(spark, path):
        path = _SCORE_TABLES[key] = new_path(spark, "rule-scores")
        sinks.write_table(revenue.rule_scores(stored_features(spark, folder)), path)
    return files.read_table(spark, path)


def national_series(spark: SparkSession, folder: str) -> DataFrame:
    daily = gold.daily_features(sales(spark, folder, "transaction_date", "purchase_amount", "electricity_units"))
    return forecast.as_series(daily, "daily_revenue")


def town_series(spark: SparkSession, folder: str) -> DataFrame:
    """Daily revenue of every town."""
    by_day = gold.daily_town(sales(spark, folder, "transaction_date", "town", "purchase_amount", "electricity_units"))
    return forecast.as_series(by_day, "revenue", key=F.col("town"))


def revenue_series(spark: SparkSession, folder: str) -> DataFrame:
    """Daily revenue of the country and of every town."""
    return national_series(spark, folder).unionByName(town_series(spark, folder))


# --- sources and sinks ----------------------------------------------------


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "csv")
    sinks.write_csv_files(raw_sales(spark, folder), path)
    return files.read_raw_csv(spark, path)


@query
def csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    """Typed read with the inferred schema."""
    path = new_path(spark, "csv")
    sinks.write_csv_files(sales(spark, folder), path)
    schema = files.infer_csv_schema(spark, path)
    return spark.read.option("header", True).schema(schema).csv(path)


@query
def parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_table(spark, f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@query
def pushed_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A filter that the scan itself applies."""
    return files.read_table(spark, f"{folder}/orders.parquet").filter("o_totalprice > 100000").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query
def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "bronze")
    sinks.write_table(raw_sales(spark, folder), path)
    return files.read_table(spark, path)


@query
def append_merge_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Sales before and from 1998, the later ones with a price per unit."""
    path = new_path(spark, "append")
    tx = sales(spark, folder, "receipt_number", "transaction_date", "purchase_amount", "electricity_units")
    # Rows without a date count as new ones; with a plain comparison they would be in neither part.
    old = F.coalesce(F.col("transaction_date") < F.lit("1998-01-01").cast("timestamp"), F.lit(False))
    sinks.append_table(tx.filter(old), path)
    sinks.append_table(tx.filter(~old).transform(clean.add_unit_price), path)
    return files.read_table(spark, path, merge_schema=True).select(*tx.columns, "price_per_unit")


@query
def csv_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "csv")
    towns = gold.town_summary(sales(spark, folder, "transaction_date", "town", "purchase_amount", "electricity_units"))
    sinks.write_csv(towns, path)
    return spark.read.option("header", True).schema(towns.schema).csv(path)


@query
def catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "table")
    monthly = gold.monthly_revenue(sales(spark, folder, "transaction_date", "purchase_amount", "electricity_units"))
    name = "monthly_" + path.rsplit("-", 1)[1]
    table = sinks.ensure_table(
        spark, "wattline", name, monthly.schema, path, database_location=new_path(spark, "database")
    )
    monthly.write.insertInto(table)
    return spark.table(table)


@query
def to_messages(spark: SparkSession, folder: str) -> DataFrame:
    sent = broker.to_messages(sale_messages(spark, folder))
    return sent.select("key", F.from_json("value", schemas.MESSAGE).alias("m")).select("key", "m.*")


@query
def table_report(spark: SparkSession, folder: str) -> DataFrame:
    return signed_sales(spark, folder).transform(clean.table_report)


# --- cleaning -------------------------------------------------------------


@query
def silver_clean(spark: SparkSession, folder: str) -> DataFrame:
    return raw_sales(spark, folder).transform(clean.silver_clean)


@query
def reversals(spark: SparkSession, folder: str) -> DataFrame:
    return signed_sales(spark, folder).transform(clean.flag_reversals).select(
        "receipt_number", "vendor_id", "purchase_amount", "is_reversal"
    )


@query
def silver_sales(spark: SparkSession, folder: str) -> DataFrame:
    return signed_sales(spark, folder).transform(clean.silver_sales)


@query
def dedup_receipts(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder).transform(clean.dedup)


@query
def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return signed_sales(spark, folder).transform(clean.cleaning_report)


# --- messages and streams -------------------------------------------------


@query
def parse_messages(spark: SparkSession, folder: str) -> DataFrame:
    """JSON with broken payloads and broken dates among it."""
    sent = broker.to_messages(sale_messages(spark, folder))
    key = F.col("key").cast("bigint")
    value = F.when(key % 19 == 0, "not json").when(
        key % 7 == 0, F.regexp_replace("value", '"transaction_date":"[^"]*"', '"transaction_date":"zz"')
    ).otherwise(F.col("value"))
    return sent.select(value.alias("value")).transform(messages.parse_messages).transform(messages.drop_empty)


@query
def normalize_messages(spark: SparkSession, folder: str) -> DataFrame:
    now = F.lit("2002-01-01 00:00:00").cast("timestamp")
    return messages.normalize_messages(loose_export(spark, folder), now)


@query
def to_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return sale_messages(spark, folder).transform(messages.to_canonical)


def _event_messages(df: DataFrame) -> DataFrame:
    tx = event_transactions(df)
    return broker.to_messages(
        tx.select(
            "transaction_id",
            F.col("meter_number").alias("meter_id"),
            "purchase_amount",
            F.col("electricity_units").alias("units_purchased"),
            "transaction_date",
            F.col("account_number").alias("customer_id"),
            F.col("town").alias("region"),
        )
    )


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a message stream, appended to bronze and read back."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    stream = _event_messages(files.parquet_stream(spark, folder, schema, "events.parquet"))
    path = new_path(spark, "stream")
    run = ingest.ingest_stream(stream, path, new_path(spark, "offsets"), {"availableNow": True}, name=None)
    run.awaitTermination()
    return files.read_table(spark, path).drop("ingestion_timestamp", "batch_id")


def _live_reports(spark: SparkSession, folder: str) -> str:
    """Events dropped as CSV files, followed by the live job; returns the folder it published."""
    drop, out = new_path(spark, "drop"), new_path(spark, "live")
    events = live_events(spark, folder)
    sinks.write_csv_files(events, drop)
    stream = files.csv_stream(spark, drop, events.schema)
    live.start_live(stream, out, new_path(spark, "offsets"), {"availableNow": True}).awaitTermination()
    return live.published(spark, out)


def _read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


@query
def live_kpis(spark: SparkSession, folder: str) -> DataFrame:
    schema = "live_revenue DOUBLE, live_units_sold DOUBLE, live_transactions BIGINT, last_updated STRING"
    return _read_report(spark, f"{_live_reports(spark, folder)}/live_kpis", schema).drop("last_updated")


@query
def live_town_activity(spark: SparkSession, folder: str) -> DataFrame:
    schema = "town STRING, live_town_revenue DOUBLE, live_town_transactions BIGINT"
    return _read_report(spark, f"{_live_reports(spark, folder)}/live_town_activity", schema)


@query
def live_alerts(spark: SparkSession, folder: str) -> DataFrame:
    schema = "meter_number BIGINT, account_number BIGINT, town STRING, purchase_amount DOUBLE, electricity_units DOUBLE"
    return _read_report(spark, f"{_live_reports(spark, folder)}/live_alerts", schema)


@query
def live_report_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts in the stored live report, which holds the largest ones."""
    return reports.alert_count(live_alerts(spark, folder))


@query
def live_alert_count(spark: SparkSession, folder: str) -> DataFrame:
    """All alerts of the event table, not only those of the stored report."""
    return reports.alert_count(risk.high_value_alerts(live_events(spark, folder), n=None))


@query
def ingest_progress(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ingest_progress(sales(spark, folder, "receipt_number"))


@query
def silver_from_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages to silver in two runs, the second over all messages again."""
    sent, path = materialize(sale_messages(spark, folder), "messages"), new_path(spark, "silver")
    medallion.silver_from_messages(sent.filter("cast(transaction_id as bigint) % 3 = 0"), path)
    name = "silver_" + path.rsplit("-", 1)[1]
    found = medallion.silver_from_messages(sent, path, database="wattline", table=name)
    return found.drop("processing_date")


# --- gold -----------------------------------------------------------------


@query
def medallion_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Exports to bronze, silver and gold, and the monthly table read back."""
    base = new_path(spark, "lake")
    sinks.write_csv_files(raw_sales(spark, folder), f"{base}/csv")
    medallion.build_bronze(spark, f"{base}/csv", f"{base}/bronze")
    silver = medallion.build_silver(spark, f"{base}/bronze", f"{base}/silver")
    return files.read_table(spark, medallion.build_gold(silver, f"{base}/gold")["monthly_revenue"])


@query
def monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return gold.monthly_revenue(sales(spark, folder, "transaction_date", "purchase_amount", "electricity_units"))


@query
def town_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.town_summary(sales(spark, folder, "transaction_date", "town", "purchase_amount", "electricity_units"))


@query
def customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.customer_summary(sales(spark, folder, *_RISK_COLUMNS))


@query
def payment_trends(spark: SparkSession, folder: str) -> DataFrame:
    return gold.payment_trends(sales(spark, folder, "transaction_date", "town", "purchase_amount", "electricity_units"))


@query
def fraud_base(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fraud_base(branch_sales(spark, folder))


@query
def anomaly_rules(spark: SparkSession, folder: str) -> DataFrame:
    base = materialize(gold.fraud_base(branch_sales(spark, folder)), "fraud-base")
    return gold.anomaly_rules(base, latest_date(spark, folder))


@query
def daily_features(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_features(sales(spark, folder, "transaction_date", "purchase_amount", "electricity_units"))


# --- features -------------------------------------------------------------


@query
def risk_base(spark: SparkSession, folder: str) -> DataFrame:
    return features.risk_base_from(profile(spark, folder))


@query
def recent_history(spark: SparkSession, folder: str) -> DataFrame:
    tx = sales(spark, folder, "transaction_date", "meter_number", "purchase_amount", "electricity_units")
    return features.recent_history(tx, latest_date(spark, folder))


@query
def risk_features(spark: SparkSession, folder: str) -> DataFrame:
    return customer_features(spark, folder)


@query
def risk_matrix(spark: SparkSession, folder: str) -> DataFrame:
    matrix = customer_features(spark, folder).transform(features.sanitize)
    return matrix.select(*schemas.CUSTOMER_KEYS, *schemas.MODEL_FEATURES)


@query
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardize(stored_features(spark, folder).transform(features.sanitize))
    return scaled.select(*schemas.CUSTOMER_KEYS, *[F.round(c, 6).alias(c) for c in schemas.MODEL_FEATURES])


@query
def token_depletion(spark: SparkSession, folder: str) -> DataFrame:
    return features.token_depletion(branch_sales(spark, folder))


@query
def top_meters(spark: SparkSession, folder: str) -> DataFrame:
    return features.top_meters(sales(spark, folder, "meter_number"), 10)


@query
def meter_daily(spark: SparkSession, folder: str) -> DataFrame:
    tx = sales(spark, folder, "meter_number", "transaction_date", "electricity_units")
    return features.meter_daily(tx, 10)


# --- risk -----------------------------------------------------------------


@query
def scenario_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = stored_features(spark, folder).transform(risk.scenario_flags)
    return flagged.select(*schemas.CUSTOMER_KEYS, *schemas.SCENARIO_FLAGS, "high_value_flag", "fraud_scenario_score")


@query
def risk_tiers(spark: SparkSession, folder: str) -> DataFrame:
    scored = stored_features(spark, folder).withColumn("risk_score", F.col("max_purchase"))
    return risk.risk_tiers(scored).select(*schemas.CUSTOMER_KEYS, "risk_score", "anomaly_score")


@query
def documented_rules(spark: SparkSession, folder: str) -> DataFrame:
    ruled = risk.documented_rules(customer_features(spark, folder))
    share = F.col("max_purchase") / F.lit(105000.0)
    return risk.risk_category(ruled, share).select(
        *schemas.CUSTOMER_KEYS, "rule_never_bought", "rule_sharp_decline", "rule_inactive_6months", "risk_category"
    )


@query
def transaction_risk(spark: SparkSession, folder: str) -> DataFrame:
    tx = sales(spark, folder, "receipt_number", *schemas.SCORING_RECORD.names)
    records = tx.withColumns(
        {"purchase_amount": F.col("purchase_amount") / 10, "outstanding_amount": F.col("outstanding_amount") * 6}
    )
    return risk.score_risk(records).select(
        "receipt_number", "town", "vendor_id", "risk_level", "risk_score", "predicted_next_purchase"
    )


# --- reports --------------------------------------------------------------


@query
def revenue_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_trend(monthly_revenue(spark, folder))


@query
def top_towns_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_towns_revenue(town_summary(spark, folder))


@query
def top_towns_units(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_towns_units(town_summary(spark, folder))


@query
def top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_customers(customer_summary(spark, folder))


@query
def payment_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return reports.payment_ranking(payment_trends(spark, folder))


@query
def anomaly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.anomaly_summary(anomaly_rules(spark, folder))


@query
def top_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_anomalies(anomaly_rules(spark, folder))


@query
def kpi_overview(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpi_overview(monthly_revenue(spark, folder), stored_rule_scores(spark, folder))


@query
def high_risk_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.high_risk_count(stored_rule_scores(spark, folder))


@query
def score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.score_distribution(stored_rule_scores(spark, folder))


@query
def scenario_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.scenario_counts(stored_rule_scores(spark, folder))


@query
def anomalies_by_town(spark: SparkSession, folder: str) -> DataFrame:
    return reports.anomalies_by_town(stored_rule_scores(spark, folder), 15)


@query
def suspicious_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    """The suspicious customer list over rule scores."""
    return reports.suspicious_customers(stored_rule_scores(spark, folder))


# --- models ---------------------------------------------------------------


@query
def forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = forest.forest_scores(stored_features(spark, folder))
    return scores.select(*schemas.CUSTOMER_KEYS, "isolation_prediction", "isolation_score", "risk_score")


@query
def anomaly_scores(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.score_customers(stored_features(spark, folder))


@query
def suspicious_customers(spark: SparkSession, folder: str) -> DataFrame:
    return revenue.suspicious_customers(branch_sales(spark, folder), latest_date(spark, folder))


@query
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.holdout(national_series(spark, folder))


@query
def forecast_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Error of repeating the value seven points earlier, on the held-out days."""
    marked = forecast.holdout(national_series(spark, folder)).transform(forecast.seasonal_naive)
    return forecast.forecast_errors(marked.filter("split = 'test'"))


@query
def future_dates(spark: SparkSession, folder: str) -> DataFrame:
    daily = features.meter_daily(sales(spark, folder, "meter_number", "transaction_date", "electricity_units"), None)
    return forecast.future_dates(forecast.as_series(daily, "y", "ds", F.col("meter_number")))


@query
def filled_series(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.fill_gaps(national_series(spark, folder))


@query
def forecast_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Next 30 days of the country and of every town."""
    ahead = forecast.forecast_arima(revenue_series(spark, folder))
    return ahead.withColumnsRenamed({"ds": "date", "forecast": "forecast_revenue"})


@query
def forecast_towns(spark: SparkSession, folder: str) -> DataFrame:
    """The same for towns by an order whose least squares have a closed form."""
    ahead = forecast.forecast_arima(town_series(spark, folder), (1, 1, 0), exact=False)
    return ahead.withColumn("forecast", F.round("forecast", 2))


@query
def model_selection(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.select_arima(revenue_series(spark, folder))


@query
def order_errors(spark: SparkSession, folder: str) -> DataFrame:
    """The selection over two orders with a closed form."""
    scored = forecast.select_arima(town_series(spark, folder), ((0, 1, 0), (1, 1, 0)), exact=False)
    return scored.withColumns({c: F.round(c, 4) for c in ("aic", "bic", "mae", "rmse", "mape")})


@query
def walk_criteria(spark: SparkSession, folder: str) -> DataFrame:
    """Information criteria of the exact likelihood for the order whose likelihood has a closed form."""
    scored = forecast.select_arima(town_series(spark, folder), ((0, 1, 0),))
    return scored.select("series_key", F.round("aic", 4).alias("aic"), F.round("bic", 4).alias("bic"), "status")


@query
def forecast_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Next 30 days of every town by a line that may turn once, whose penalised fit has a closed form."""
    ahead = forecast.forecast_seasonal(town_series(spark, folder), hinges=1, yearly=0, weekly=0)
    return ahead.select("series_key", "ds", F.round("yhat", 2).alias("yhat"))


@query
def forecast_units(spark: SparkSession, folder: str) -> DataFrame:
    """Next 30 days of every meter."""
    daily = features.meter_daily(sales(spark, folder, "meter_number", "transaction_date", "electricity_units"), None)
    series = forecast.as_series(daily, "y", "ds", F.col("meter_number"))
    return forecast.forecast_seasonal(series).withColumnRenamed("series_key", "meter_number")


@query
def forecast_unit_days(spark: SparkSession, folder: str) -> DataFrame:
    """Meters and days of the unit forecasts, and whether each forecast lies in its interval."""
    inside = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return forecast_units(spark, folder).select("meter_number", "ds", inside.alias("inside"))
