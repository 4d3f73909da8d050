"""Raw rows to silver: casts, text, duplicates, reversals, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.casting import (
    lenient_double,
    lenient_integer,
    lenient_timestamp,
    trimmed,
    upper_trimmed,
)
from wattline.functions.measures import count_where
from wattline.functions.quantiles import attach_scalars
from wattline.schemas import AMOUNTS

# Spellings found in exports, and the canonical name of each.
ALIASES = {"customer_connectedate": "customer_connectdate", "Tax_amount": "tax_amount"}


def canonical_names(df: DataFrame) -> DataFrame:
    present = {old: new for old, new in ALIASES.items() if old in df.columns}
    return df.withColumnsRenamed(present)


def cast_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: lenient_double(F.col(c)) for c in AMOUNTS if c in df.columns})


def cast_ids(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "vendor_id": lenient_integer(F.col("vendor_id"), "int"),
            "meter_number": lenient_integer(F.col("meter_number")),
            "receipt_number": lenient_integer(F.col("receipt_number")),
        }
    )


def parse_times(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    times = [c for c in ("transaction_date", "customer_connectdate") if c in types]
    return df.withColumns({c: lenient_timestamp(F.col(c)) for c in times if types[c] != "timestamp"})


def clean_text(df: DataFrame) -> DataFrame:
    plain = {c: trimmed(F.col(c)) for c in ("account_number", "vending_category")}
    upper = {c: upper_trimmed(F.col(c)) for c in ("consumer_surname", "consumer_first_name", "town")}
    return df.withColumns({**plain, **upper})


def stamp(df: DataFrame, name: str = "ingestion_timestamp") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> list[Column]:
    """`order_by`, then every other column: rows that still tie are equal."""
    named = {*keys, *(c for c in order_by if isinstance(c, str))}
    rest = [F.col(c) for c in df.columns if c not in named]
    return [F.col(c) if isinstance(c, str) else c for c in order_by] + rest


def dedup(
    df: DataFrame,
    keys: Sequence[str] = ("receipt_number",),
    order_by: Sequence[str | Column] = (),
    keep_null_keys: bool = False,
) -> DataFrame:
    """The first row per key in a total order, so that reruns keep the same row.

    NULL keys are one group unless `keep_null_keys`; keeping them reads the input
    twice, so give a stored one. Filtering on the row number
    lets Spark keep one row per key in each task before the shuffle, so a key
    with a third of all rows ships one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order_by))
    if not keep_null_keys:
        return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    return dedup(df.filter(keyed), keys, order_by).unionByName(df.filter(~keyed))


def silver_clean(raw: DataFrame, keep_null_keys: bool = False) -> DataFrame:
    """The file-export route to silver: names, casts, text, one row per receipt."""
    df = raw.transform(canonical_names).transform(parse_times).transform(cast_amounts)
    return df.transform(cast_ids).transform(clean_text).transform(dedup, keep_null_keys=keep_null_keys)


def flag_reversals(df: DataFrame) -> DataFrame:
    return df.withColumn("is_reversal", F.coalesce(F.col("purchase_amount") < 0, F.lit(False)))


def keep_sales(df: DataFrame) -> DataFrame:
    """Positive sales only; zero and NULL amounts go with the reversals."""
    return (
        df.transform(flag_reversals)
        .filter(~F.col("is_reversal") & (F.col("purchase_amount") > 0))
        .drop("is_reversal")
        .withColumn("layer", F.lit("silver"))
    )


def add_calendar(df: DataFrame) -> DataFrame:
    """Year, month, day of week (1 = Sunday) and the weekend flag."""
    day = F.dayofweek("transaction_date")
    return df.withColumns(
        {
            "year": F.year("transaction_date"),
            "month": F.month("transaction_date"),
            "day_of_week": day,
            "is_weekend": F.when(day.isin(1, 7), 1).otherwise(0),
        }
    )


def add_unit_price(df: DataFrame) -> DataFrame:
    units = F.col("electricity_units")
    return df.withColumn(
        "price_per_unit", F.when(units > 0, F.col("purchase_amount") / units).otherwise(F.lit(0.0))
    )


def silver_sales(bronze: DataFrame, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The message route to silver: one row per receipt, sales only, calendar, price."""
    return (
        bronze.transform(dedup, order_by=order_by)
        .transform(keep_sales)
        .transform(parse_times)
        .transform(add_calendar)
        .transform(add_unit_price)
    )


def cleaning_report(
    df: DataFrame, key: str = "receipt_number", order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Bronze rows, duplicates removed and rows left after cleaning.

    The kept rows come from `dedup`, which ships one row per key and task; the row count reads no columns.
    """
    kept = dedup(df, (key,), order_by).agg(
        F.count("*").alias("kept"), count_where(F.col("purchase_amount") > 0).alias("rows_after_cleaning")
    )
    both = attach_scalars(kept, df.agg(F.count("*").alias("bronze_rows")))
    return both.select(
        F.col("stats.bronze_rows").alias("bronze_rows"),
        (F.col("stats.bronze_rows") - F.col("kept")).alias("duplicates_removed"),
        "rows_after_cleaning",
    )


def table_report(df: DataFrame) -> DataFrame:
    """Row count, NULL count and type of every column, in one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    lines = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f.name)).alias("null_count"),
        )
        for f in df.schema
    ]
    return counts.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
