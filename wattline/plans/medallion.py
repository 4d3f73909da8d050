"""Raw exports to bronze, silver and gold tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.measures import count_where
from wattline.operators import features, forecast, gold
from wattline.operators import forest as outlier_forest
from wattline.operators.clean import add_calendar, silver_clean, silver_sales, stamp
from wattline.operators.features import sanitize
from wattline.operators.messages import to_canonical
from wattline.plans.revenue import score_customers
from wattline.sources.files import exists, read_raw_csv, read_table
from wattline.sources.sinks import append_table, ensure_table, layout, write_table

# Gold tables of a few rows per month or town, kept in one file each.
_SMALL = ("monthly_revenue", "town_summary", "payment_trends", "daily_features")


def build_bronze(spark: SparkSession, csv_path: str, out: str, fmt: str = "parquet") -> DataFrame:
    """Export files to an all-text table; each input split becomes one file."""
    write_table(read_raw_csv(spark, csv_path), out, fmt=fmt)
    return read_table(spark, out, fmt)


def build_silver(spark: SparkSession, bronze: str, out: str, fmt: str = "parquet") -> DataFrame:
    """Typed, deduplicated table partitioned by month, for pruning by date."""
    clean = read_table(spark, bronze, fmt).transform(silver_clean).transform(stamp)
    dated = clean.transform(add_calendar).drop("day_of_week", "is_weekend")
    write_table(layout(dated, by=["year", "month"]), out, fmt=fmt, partition_by=["year", "month"])
    return read_table(spark, out, fmt)


def build_gold(
    silver: DataFrame, out: str, as_of: Column | datetime.date | None = None, fmt: str = "parquet"
) -> dict[str, str]:
    """Write every gold table; returns name -> path.

    Silver is read twice and no more: once per day and town for the calendar
    and town tables and the last day, once per customer for everything else.
    """
    spark = silver.sparkSession
    paths = {
        name: f"{out}/{name}"
        for name in (
            *("daily_town", "customer_profile", "meter_behaviour", *_SMALL),
            *("customer_summary", "gold_anomaly_rules", "token_depletion", "risk_features"),
        )
    }

    def store(name: str, df: DataFrame) -> DataFrame:
        write_table(layout(df, files=1) if name in _SMALL else df, paths[name], fmt=fmt)
        return read_table(spark, paths[name], fmt)

    by_day = store("daily_town", gold.daily_town(silver))
    for name in _SMALL:
        store(name, getattr(gold, name)(by_day))

    day = by_day.agg(F.max("date")).scalar() if as_of is None else as_of
    profile = store("customer_profile", features.customer_profile(silver, day))
    store("customer_summary", gold.customer_summary_from(profile))
    store("token_depletion", features.token_depletion_from(profile))
    store("gold_anomaly_rules", gold.anomaly_rules(gold.fraud_base_from(profile), day))
    behaviour = store("meter_behaviour", features.recent_history_from(profile))
    store("risk_features", features.risk_features(profile, behaviour))
    return paths


def build_scores(risk_features: DataFrame, out: str, fmt: str = "parquet", **forest) -> DataFrame:
    """Forest and scenario scores of stored risk features to `gold_anomaly_scores`, and the forest to `gold_forest`.

    The stored forest scores another table with `nodes=read_table(spark, f"{out}/gold_forest")`.
    """
    spark = risk_features.sparkSession
    if "nodes" not in forest:
        options = {k: forest.pop(k) for k in ("trees", "sample", "seed") if k in forest}
        write_table(outlier_forest.grow_forest(sanitize(risk_features), **options), f"{out}/gold_forest", fmt=fmt)
        forest["nodes"] = read_table(spark, f"{out}/gold_forest", fmt)
    write_table(score_customers(risk_features, **forest), f"{out}/gold_anomaly_scores", fmt=fmt)
    return read_table(spark, f"{out}/gold_anomaly_scores", fmt)


def silver_from_messages(
    messages: DataFrame, out: str, fmt: str = "parquet", database: str | None = None, table: str = "silver_sales"
) -> DataFrame:
    """The message route: bronze messages to sales in silver, appended, and registered if a database is named.

    Receipts that silver holds already are left alone, so running it again over the same bronze adds nothing and over a
    grown one adds what is new. Rows without a receipt are one receipt, as in `dedup`. New columns are united with the old
    ones on reading.
    """
    spark = messages.sparkSession
    fresh = messages.transform(to_canonical).transform(silver_sales).transform(stamp, "processing_date")
    if exists(spark, out):
        known = read_table(spark, out, fmt).select(F.col("receipt_number").alias("known_receipt"))
        # By plain equality the join takes the rows where `dedup` left them; a NULL receipt matches nothing and is looked up apart.
        unnamed = known.agg(count_where(F.col("known_receipt").isNull()) > 0).scalar()
        fresh = fresh.join(known, fresh["receipt_number"] == known["known_receipt"], "left_anti")
        fresh = fresh.filter(F.col("receipt_number").isNotNull() | ~unnamed)
    append_table(fresh, out, fmt)
    if database:
        ensure_table(spark, database, table, None, out, fmt)
    return read_table(spark, out, fmt, merge_schema=True)


def build_forecasts(
    daily: DataFrame, meter_days: DataFrame, out: str, fmt: str = "parquet", horizon: int = forecast.HORIZON
) -> dict[str, str]:
    """Write the forecast tables; returns name -> path.

    `daily` and `meter_days` are series (`series_key`, `ds`, `y`): revenue of the country, of towns or both, and units
    of each meter. The first also gives the comparison of ARIMA orders.
    """
    tables = {
        "revenue_forecast": forecast.forecast_arima(daily, horizon=horizon).withColumnsRenamed(
            {"ds": "date", "forecast": "forecast_revenue"}
        ),
        "model_comparison": forecast.select_arima(daily),
        "unit_forecast": forecast.forecast_seasonal(meter_days, horizon),
    }
    for name, table in tables.items():
        write_table(table, f"{out}/{name}", fmt=fmt)
    return {name: f"{out}/{name}" for name in tables}
