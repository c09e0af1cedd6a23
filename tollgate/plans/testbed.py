"""Testbed: the driver's synthetic tables seen as usage records.

``events`` rows become raw CDRs and ``customer`` rows become subscribers, so
every query reads the given tables and its work grows with them.  The rules
(ours, not the source system's) exercise every validation branch:

* ``props.k`` decides corruption: k < 3 no subscriber, k < 6 a test number,
  k < 8 a non-numeric subscriber, k in (8, 9) no record type, k = 10 a
  negative call duration, k % 7 = 0 a voice call without callee.
* ``event_type`` decides the record shape (see ``EVENT_SHAPES``).
* The events lie within one month; ``event_id`` modulo 3 moves a record on by so
  many times 31 days, so that there are several billing months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tollgate.operators.mediation import decode
from tollgate.plans.joins import SALTS, join_dimension
from tollgate.schemas import RAW_CDR

# ---------------------------------------------------------------------------
# Fixed values of the testbed mapping
EVENT_SHAPES = {"view": "voice", "click": "voice", "purchase": "data", "signup": "sms"}
OTHER_SHAPE = "other"
COUNTRY_CODE = "212"
TEST_PREFIX = "999"
TEXT_SUBSCRIBER = "front-desk"
NUMBER_DIGITS = 9
MONTHS_APART, MONTH_DAYS = 3, 31
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# ---------------------------------------------------------------------------

PROPS = StructType([StructField("k", IntegerType(), True)])


def _number(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), NUMBER_DIGITS, "0"))


def decode_props(events: DataFrame) -> DataFrame:
    """events with the JSON ``props`` decoded to its integer ``k``."""
    return decode(
        events,
        PROPS,
        value_col="props",
        keep=("event_id", "ts", "user_id", "event_type", "value"),
    )


def _shape() -> F.Column:
    et = F.col("event_type")
    expr = None
    for event_type, shape in EVENT_SHAPES.items():
        expr = (F.when(et == event_type, shape) if expr is None else expr.when(et == event_type, shape))
    return expr.otherwise(OTHER_SHAPE)


def raw_records(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """events -> typed raw CDRs (RAW_CDR columns after the ``keep`` columns of events)."""
    k = F.col("k")
    shape = F.col("shape")
    sub = (
        F.when(k < 3, F.lit(None).cast("string"))
        .when(k < 6, _number(TEST_PREFIX, F.col("user_id")))
        .when(k < 8, F.lit(TEXT_SUBSCRIBER))
        .otherwise(_number(COUNTRY_CODE, F.col("user_id")))
    )
    other_party = _number(COUNTRY_CODE, k)
    whole = F.floor(F.col("value"))
    moved = F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % MONTHS_APART * MONTH_DAYS).cast("int"))
    cols = {
        "record_type": F.when(k.isin(8, 9), F.lit(None).cast("string")).otherwise(shape),
        "timestamp": F.date_format(moved, TIMESTAMP_FORMAT),
        "caller_id": F.when(shape == "voice", sub),
        "callee_id": F.when((shape == "voice") & (k % 7 != 0), other_party),
        "sender_id": F.when(shape == "sms", sub),
        "receiver_id": F.when(shape == "sms", other_party),
        "user_id": F.when(shape.isin("data", OTHER_SHAPE), sub),
        "duration_sec": F.when(shape == "voice", F.when(k == 10, -whole).otherwise(whole)),
        "data_volume_mb": F.when(shape == "data", F.col("value")),
        "session_duration_sec": F.when(shape == "data", F.floor(F.col("value") * 10)),
        "cell_id": F.concat(F.lit("CELL_"), (k % 3).cast("string")),
        "technology": F.concat((k % 4 + 2).cast("string"), F.lit("G")),
    }
    base = decode_props(events).withColumn("shape", _shape())
    record = F.struct(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RAW_CDR.fields])
    # The records leave the testbed like rows of a source: flattened by a
    # generator, so the pipeline's filters stay on the generated columns
    # instead of being rewritten into copies of the mapping expressions.
    return base.select(*keep, F.inline(F.array(record)))


def raw_messages(events: DataFrame) -> DataFrame:
    """events -> raw CDR messages: a binary JSON ``value`` like a topic gives
    (absent fields are left out of the JSON)."""
    raw = raw_records(events)
    return raw.select(F.to_json(F.struct(*raw.columns)).cast("binary").alias("value"))


def customers_from(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer (+ nation names) -> the ``customers`` table: id ``+212`` and the
    zero-padded key, plan RP1 for even keys and RP2 for odd, active when the
    account balance is not negative, region = nation name."""
    names = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = join_dimension(customer, names, ["c_nationkey"], "left", SALTS, salt_by=["c_custkey"])
    key = F.col("c_custkey")
    return joined.select(
        F.concat(F.lit("+"), _number(COUNTRY_CODE, key)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lit("postpaid").alias("subscription_type"),
        F.when(key % 2 == 0, "RP1").otherwise("RP2").alias("rate_plan_id"),
        F.lit(None).cast("date").alias("activation_date"),
        F.when(F.col("c_acctbal") >= 0, "active").otherwise("suspended").alias("status"),
        F.col("n_name").alias("region"),
    )
