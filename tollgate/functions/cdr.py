"""Record-level rules as Spark Column expressions.

Everything here is a built-in expression, so it stays inside whole-stage
codegen and works the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
#   - subscriber number accepted as a customer: "^212\d{9}$"
#   - test-number prefix that makes a record invalid: "999"
#   - customer id = "+" followed by the subscriber number
#   - billing month format: "yyyy-MM"
#   - service types: "voice" (seconds), "sms" (1 per message), "data" (MB)
# ---------------------------------------------------------------------------
CUSTOMER_NUMBER_PATTERN = r"^212\d{9}$"
TEST_NUMBER_PREFIX = "999"
CUSTOMER_ID_PREFIX = "+"
MONTH_FORMAT = "yyyy-MM"
VOICE, SMS, DATA = "voice", "sms", "data"
# Exact money type of the opt-in decimal pricing.
MONEY_EXACT = DecimalType(38, 6)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def subscriber() -> Column:
    """The charged party: first of caller, sender, user (whatever the type)."""
    return F.coalesce(F.col("caller_id"), F.col("sender_id"), F.col("user_id"))


def peer() -> Column:
    """The other party: callee, else receiver."""
    return F.coalesce(F.col("callee_id"), F.col("receiver_id"))


def usage_duration() -> Column:
    """Call length, else data-session length."""
    return F.coalesce(F.col("duration_sec"), F.col("session_duration_sec"))


def is_valid(msisdn: str | Column = "msisdn", record_type: str | Column = "record_type") -> Column:
    """False for a missing subscriber, a test number or a missing type; never null."""
    m, t = _c(msisdn), _c(record_type)
    return (
        F.when(m.isNull(), F.lit(False))
        .when(m.startswith(TEST_NUMBER_PREFIX), F.lit(False))
        .when(t.isNull(), F.lit(False))
        .otherwise(F.lit(True))
    )


# Opt-in rejection rules beyond the three default ones (``validate(...,
# reject=...)``).  Each is true for a record to reject; the default
# validation keeps all of these records.
def _negative_usage() -> Column:
    return (F.col("duration") < 0) | (F.col("volume_mb") < 0)


def _missing_peer() -> Column:
    return F.col("record_type").isin(VOICE, SMS) & F.col("peer_id").isNull()


def _unknown_type() -> Column:
    return ~F.col("record_type").isin(VOICE, SMS, DATA)


def _bad_timestamp() -> Column:
    return event_time("timestamp").isNull()


def _not_a_customer() -> Column:
    return customer_id_of("msisdn").isNull()


STRICT_RULES = {
    "negative_usage": _negative_usage,
    "missing_peer": _missing_peer,
    "unknown_type": _unknown_type,
    "bad_timestamp": _bad_timestamp,
    "not_a_customer": _not_a_customer,
}


def is_valid_strict(reject=tuple(STRICT_RULES)) -> Column:
    """:func:`is_valid` and none of the named ``STRICT_RULES``; never null."""
    unknown = set(reject) - set(STRICT_RULES)
    if unknown:
        raise ValueError(f"unknown rules {sorted(unknown)}")
    cond = is_valid()
    for name in reject:
        cond = cond & ~F.coalesce(STRICT_RULES[name](), F.lit(False))
    return cond


def is_customer_number(msisdn: str | Column = "msisdn") -> Column:
    """True for a domestic subscriber number (null for a null number)."""
    return _c(msisdn).rlike(CUSTOMER_NUMBER_PATTERN)


def customer_id_of(msisdn: str | Column = "msisdn") -> Column:
    """E.164 customer id for a domestic subscriber number, else null."""
    m = _c(msisdn)
    return F.when(is_customer_number(m), F.concat(F.lit(CUSTOMER_ID_PREFIX), m))


def receiver_of(record_type: str | Column = "record_type", peer_id: str | Column = "peer_id") -> Column:
    t = _c(record_type)
    return F.when(t.isin(SMS, VOICE), _c(peer_id))


def callee_of(record_type: str | Column = "record_type", peer_id: str | Column = "peer_id") -> Column:
    return F.when(_c(record_type) == VOICE, _c(peer_id))


def event_time(text: str | Column = "timestamp") -> Column:
    """ISO-8601 text to a timestamp; unparseable text gives null (never raises)."""
    return F.try_to_timestamp(_c(text))


def utc_wall_clock(ts: str | Column, time_zone: str = "UTC") -> Column:
    """Wall-clock time of an instant in ``time_zone``, whatever the session zone.

    Built from the instant's microseconds, not through a wall clock of the
    session zone, which would be ambiguous when clocks go back.
    """
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=(F.unix_micros(_c(ts)).cast("decimal(20, 0)") / 1_000_000).cast("decimal(18, 6)")
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)


def billing_month(ts: str | Column = "timestamp", time_zone: str = "UTC") -> Column:
    """``yyyy-MM`` of the event in the billing time zone; null time gives null."""
    return F.date_format(utc_wall_clock(ts, time_zone), MONTH_FORMAT)


def consumption_units(
    record_type: str | Column = "record_type",
    duration_sec: str | Column = "duration_sec",
    data_volume_mb: str | Column = "data_volume_mb",
) -> Column:
    """Seconds for voice, 1 per sms, MB for data, 0 otherwise (as double)."""
    t = _c(record_type)
    return (
        F.when(t == VOICE, _c(duration_sec))
        .when(t == SMS, F.lit(1))
        .when(t == DATA, _c(data_volume_mb))
        .otherwise(F.lit(0))
        .cast("double")
    )


def billable_units(total: str | Column = "total_consumption_units", free: str | Column = "free_units") -> Column:
    """Units above the allowance; 0 when within it or when no allowance is known."""
    t, f = _c(total), _c(free)
    return F.when(t > f, t - f).otherwise(F.lit(0)).cast("double")


def money(c: str | Column) -> Column:
    """``c`` as exact money, ``decimal(38, 6)``."""
    return _c(c).cast(MONEY_EXACT)


def billable_units_exact(
    total: str | Column = "total_consumption_units", free: str | Column = "free_units"
) -> Column:
    """:func:`billable_units` in ``decimal(38, 6)``."""
    t, f = money(total), money(free)
    return money(F.when(t > f, t - f).otherwise(F.lit(0)))
