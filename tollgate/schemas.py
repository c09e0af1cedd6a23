"""Declared schemas of the message streams and tables.

Nothing is inferred: raw and mediated messages are parsed with these
schemas, and the stored tables keep these column orders and types.
"""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Raw usage record as produced by the network: a union of the voice, sms and
# data shapes told apart by record_type.
RAW_CDR = _schema(
    ("record_type", StringType()),
    ("timestamp", StringType()),
    ("caller_id", StringType()),
    ("callee_id", StringType()),
    ("sender_id", StringType()),
    ("receiver_id", StringType()),
    ("user_id", StringType()),
    ("duration_sec", IntegerType()),
    ("data_volume_mb", DoubleType()),
    ("session_duration_sec", IntegerType()),
    ("cell_id", StringType()),
    ("technology", StringType()),
)

# Mediated record as read back from the valid-record topic.  Duration is
# read as long although mediation writes an int.
MEDIATED_CDR = _schema(
    ("record_type", StringType()),
    ("timestamp", StringType()),
    ("cell_id", StringType()),
    ("technology", StringType()),
    ("msisdn", StringType()),
    ("peer_id", StringType()),
    ("duration", LongType()),
    ("volume_mb", DoubleType()),
    ("status", StringType()),
)

# Coordinates of the raw message in the raw topic, carried in the mediated one:
# they stay the same when a replayed batch sends a message again.
RAW_KEYS = ("raw_topic", "raw_partition", "raw_offset")
KEYED_CDR = StructType(
    MEDIATED_CDR.fields
    + _schema((RAW_KEYS[0], StringType()), (RAW_KEYS[1], IntegerType()), (RAW_KEYS[2], LongType())).fields
)

NORMALISED_CDR = _schema(
    ("record_type", StringType()),
    ("customer_id", StringType()),
    ("cell_id", StringType()),
    ("technology", StringType()),
    ("receiver_id", StringType()),
    ("callee_id", StringType()),
    ("duration_sec", LongType()),
    ("data_volume_mb", DoubleType()),
    ("session_duration_sec", LongType()),
    ("timestamp", TimestampType()),
)

# PostgreSQL NUMERIC without precision arrives through JDBC as decimal(38,18).
MONEY = DecimalType(38, 18)

CUSTOMERS = _schema(
    ("customer_id", StringType()),
    ("customer_name", StringType()),
    ("subscription_type", StringType()),
    ("rate_plan_id", StringType()),
    ("activation_date", DateType()),
    ("status", StringType()),
    ("region", StringType()),
)

RATE_PLANS = _schema(
    ("rate_plan_id", StringType()),
    ("plan_name", StringType()),
)

PRODUCTS = _schema(
    ("product_code", StringType()),
    ("service_type", StringType()),
    ("unit", StringType()),
    ("rate_type", StringType()),
)

PRODUCT_RATES = _schema(
    ("rate_plan_id", StringType()),
    ("service_type", StringType()),
    ("unit_price", MONEY),
    ("free_units", MONEY),
    ("tiered", BooleanType()),
)

RATED_USAGE = _schema(
    ("customer_id", StringType()),
    ("rate_plan_id", StringType()),
    ("record_type", StringType()),
    ("year_month", StringType()),
    ("total_consumption_units", DoubleType()),
    ("free_units", MONEY),
    ("billable_units", DoubleType()),
    ("unit_price", MONEY),
    ("cost", DoubleType()),
)

BILLS = _schema(
    ("customer_id", StringType()),
    ("year_month", StringType()),
    ("total_amount", DoubleType()),
    ("num_services", LongType()),
    ("rate_plan_id", StringType()),
)

# Columns that unification folds into msisdn / peer_id / volume_mb / duration.
UNIFIED_AWAY = (
    "caller_id",
    "callee_id",
    "sender_id",
    "receiver_id",
    "user_id",
    "data_volume_mb",
    "duration_sec",
    "session_duration_sec",
)
