"""Stream messages: parsing, lineage, normalisation, canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.casting import lenient_double, lenient_timestamp
from wattline.schemas import MESSAGE


def parse_messages(df: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """JSON in `value` to flat columns; a bad field is NULL, bad JSON is all NULL.

    The struct is unfolded by a generator, so that a later filter on a field
    does not parse every message a second time. Times are taken as text and converted afterwards: the JSON reader raises
    and catches an error for every bad one, several times the cost of a row.
    A plain number of five digits or more counts seconds since 1970.
    """
    times = [f.name for f in schema if isinstance(f.dataType, T.TimestampType)]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in times else f for f in schema])
    parsed = df.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), as_text))))

    def moment(c: Column) -> Column:
        seconds = F.timestamp_seconds(F.when(c.rlike(r"^-?\d{5,17}$"), c).try_cast("decimal(20,0)"))
        return F.coalesce(seconds, lenient_timestamp(c))

    return parsed.withColumns({name: moment(F.col(name)) for name in times})


def add_lineage(df: DataFrame, source: str = "kafka") -> DataFrame:
    """Load time, a fresh id per row, the source and a pending quality mark."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "batch_id": F.uuid(),
            "source_file": F.lit(source),
            "data_quality_status": F.lit("PENDING"),
        }
    )


def drop_empty(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    return df.filter(F.col(id_col).isNotNull())


def normalize_messages(df: DataFrame, now: Column, row_id: str = "row_id") -> DataFrame:
    """Loose export columns to the message layout, with aliases and defaults.

    `row_id` names a column that identifies the row; missing ids are built from
    it, so no task needs to know how many rows the others hold.
    """
    names = set(df.columns)

    def text(*candidates: str, default: Column) -> Column:
        found = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in candidates if c in names]
        return F.coalesce(*found, default)

    def number(*candidates: str) -> Column:
        found = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in candidates if c in names]
        return F.coalesce(lenient_double(F.coalesce(*found, F.lit("0"))), F.lit(0.0))

    def numbered(prefix: str) -> Column:
        return F.concat(F.lit(prefix), F.col(row_id).cast("string"))

    when = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("timestamp", "date", "transaction_date") if c in names]
    made_up_id = F.concat(numbered("TXN_"), F.lit("_"), F.unix_timestamp(now).cast("string"))
    return df.select(
        text("transaction_id", default=made_up_id).alias("transaction_id"),
        text("meter_id", default=numbered("METER_")).alias("meter_id"),
        text("token_id", default=numbered("TOKEN_")).alias("token_id"),
        number("purchase_amount", "amount").alias("purchase_amount"),
        number("units_purchased", "units").alias("units_purchased"),
        text("vendor_id", default=F.lit("VENDOR_001")).alias("vendor_id"),
        text("vending_point_id", "vending_point", default=F.lit("VP_001")).alias("vending_point_id"),
        F.coalesce(lenient_timestamp(F.coalesce(*when, F.lit(None))), now).alias("transaction_date"),
        text("payment_method", default=F.lit("CASH")).alias("payment_method"),
        text("customer_id", default=numbered("CUST_")).alias("customer_id"),
        text("region", default=F.lit("UNKNOWN")).alias("region"),
    )


def to_canonical(df: DataFrame) -> DataFrame:
    """Message columns under the names silver expects.

    Ids stay text: turning `TXN_7` into a number would make every such receipt
    NULL and so a duplicate of the others.
    """
    return df.select(
        F.col("transaction_date"),
        F.col("vendor_id"),
        F.col("meter_id").alias("meter_number"),
        F.col("customer_id").alias("account_number"),
        F.col("transaction_id").alias("receipt_number"),
        F.col("purchase_amount"),
        F.col("units_purchased").alias("electricity_units"),
        F.col("region").alias("town"),
    )
