"""Monthly bills from rated usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bill_monthly(rated: DataFrame, plan_pick: str = "min") -> DataFrame:
    """One bill per customer and month.

    total_amount sums the priced services (unpriced ones are skipped, all
    unpriced gives null); num_services counts distinct services, unpriced
    included; rate_plan_id is the customer's plan in that month.  With one
    plan per customer and month every pick gives the same value; ``min`` is
    deterministic when there are two, ``first`` is available for parity.

    Input rows are already one per (customer, plan, service, month), so the
    grouping is skew-free whatever the raw record distribution was.

    ``min`` and the distinct services come from the sets of a group's plans and
    services, a handful of values each: one partial and one final aggregate,
    where ``min`` on a string and a distinct count take four sorted ones.
    ``plan_pick="key"`` groups by the plan instead: the same bills whenever a customer has one plan in a month (customer ids
    unique in the customer table, one rating run billed); a customer with two
    plans in a month then gets one bill per plan.
    """
    keys = ["customer_id", "year_month"]
    totals = [F.sum("cost").alias("total_amount"), F.countDistinct("record_type").alias("num_services")]
    if plan_pick == "key":
        bills = rated.groupBy(*keys, "rate_plan_id").agg(*totals)
    elif plan_pick == "first":
        bills = rated.groupBy(*keys).agg(*totals, F.first("rate_plan_id").alias("rate_plan_id"))
    elif plan_pick == "min":
        bills = rated.groupBy(*keys).agg(
            totals[0],
            F.size(F.collect_set("record_type")).cast("long").alias("num_services"),
            F.array_min(F.collect_set("rate_plan_id")).alias("rate_plan_id"),
        )
    else:
        raise ValueError(f"unknown plan_pick {plan_pick!r}")
    return bills.select(*keys, "total_amount", "num_services", "rate_plan_id")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """Any ``rows`` rows, to look at; which ones is not defined."""
    return df.limit(rows)
