"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tollgate.functions.cdr import (
    STRICT_RULES,
    billable_units,
    billable_units_exact,
    billing_month,
    callee_of,
    consumption_units,
    customer_id_of,
    event_time,
    is_customer_number,
    is_valid,
    is_valid_strict,
    money,
    peer,
    receiver_of,
    subscriber,
    usage_duration,
    utc_wall_clock,
)

__all__ = [
    "STRICT_RULES",
    "billable_units",
    "billable_units_exact",
    "billing_month",
    "callee_of",
    "consumption_units",
    "customer_id_of",
    "event_time",
    "is_customer_number",
    "is_valid",
    "is_valid_strict",
    "money",
    "peer",
    "receiver_of",
    "subscriber",
    "usage_duration",
    "utc_wall_clock",
]
