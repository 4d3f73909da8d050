"""Schemas of the inputs and of the fixed-layout tables."""

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Fields from `name TYPE, ...`; usable before any session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Fixed by the contract, from here to the end: names, types and their order are the layouts that tables, messages and
# requests come in and go out with.

# The canonical transaction: what every operator below silver reads.
TRANSACTION = _struct(
    """
    transaction_date TIMESTAMP, vendor_id INT, meter_number BIGINT, account_number STRING,
    receipt_number BIGINT, purchase_amount DOUBLE, electricity_units DOUBLE, tax_amount DOUBLE,
    tariff_charge DOUBLE, fixed_charge DOUBLE, arrears_paid DOUBLE, consumer_surname STRING,
    consumer_first_name STRING, customer_connectdate TIMESTAMP, vending_category STRING,
    town STRING, outstanding_amount DOUBLE
    """
)

# The same columns as they arrive in a CSV export: all text.
RAW_TRANSACTION = T.StructType([T.StructField(f.name, T.StringType()) for f in TRANSACTION])

MESSAGE = _struct(
    """
    transaction_id STRING, meter_id STRING, token_id STRING, purchase_amount DOUBLE,
    units_purchased DOUBLE, vendor_id STRING, vending_point_id STRING,
    transaction_date TIMESTAMP, payment_method STRING, customer_id STRING, region STRING
    """
)

BRONZE_MESSAGE = T.StructType(
    MESSAGE.fields
    + _struct(
        """
        ingestion_timestamp TIMESTAMP, batch_id STRING, source_file STRING,
        data_quality_status STRING
        """
    ).fields
)

SCORING_RECORD = _struct(
    """
    town STRING, vendor_id STRING, purchase_amount DOUBLE, electricity_units DOUBLE,
    outstanding_amount DOUBLE
    """
)

AMOUNTS = (
    "purchase_amount",
    "electricity_units",
    "tax_amount",
    "tariff_charge",
    "fixed_charge",
    "arrears_paid",
    "outstanding_amount",
)

CUSTOMER_KEYS = ("meter_number", "account_number", "town")

# The numeric features the outlier model reads.
MODEL_FEATURES = (
    "transaction_count",
    "total_spent",
    "avg_purchase",
    "max_purchase",
    "std_purchase",
    "total_units",
    "avg_units",
    "max_units",
    "std_units",
    "customer_lifetime_days",
    "avg_depletion_interval_days",
    "inactive_days",
    "recent_avg_units",
    "recent_avg_purchase",
    "recent_transaction_count",
    "historical_avg_units",
    "historical_avg_purchase",
    "historical_transaction_count",
    "consumption_drop_ratio",
    "purchase_spike_ratio",
    "unit_spike_ratio",
)

SCENARIO_FLAGS = (
    "irregular_vending_volume_flag",
    "frequent_transaction_flag",
    "unusual_depletion_interval_flag",
    "sudden_consumption_drop_flag",
    "purchase_spike_flag",
    "unit_spike_flag",
    "inactive_customer_flag",
    "high_variability_flag",
)
