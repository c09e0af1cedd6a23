"""Spark-native engine for telecom usage records (CDRs).

Pipeline: raw JSON messages -> mediation (decode, unify, validate, split)
-> normalisation into the storage table -> monthly rating against a price
book with free allowances -> monthly bills.  Every step is a pure
``DataFrame -> DataFrame`` operator built from Spark's own expressions, so
record-level steps run unchanged on batch and streaming frames.
"""

from tollgate.operators.mediation import decode, unify, validate, split, encode, mediate
from tollgate.operators.normalise import normalise
from tollgate.operators.rating import (
    active_customers,
    cdr_with_plan,
    latest_runs,
    monthly_consumption,
    price,
    rate_monthly,
    with_run,
)
from tollgate.operators.billing import bill_monthly

__all__ = [
    "decode",
    "unify",
    "validate",
    "split",
    "encode",
    "mediate",
    "normalise",
    "active_customers",
    "cdr_with_plan",
    "monthly_consumption",
    "price",
    "rate_monthly",
    "with_run",
    "latest_runs",
    "bill_monthly",
]
