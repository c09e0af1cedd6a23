"""Monthly rating: consumption per customer, plan, service and month, priced
against the plan's price book with a monthly free allowance.

Scale notes
-----------
* Usage is aggregated per (customer, service, month) *before* it meets the
  customer table.  Partial (map-side) aggregation collapses a subscriber that
  holds a large share of all records into one row per task, so neither the
  aggregation shuffle nor the customer join sees the hot key.
* The customer join then sees at most (services x months) rows per customer;
  AQE chooses broadcast or sort-merge from the sizes it has measured.  When it
  broadcasts the customers, the usage is shuffled once, for its aggregation.
* The aggregation over the plan keys keeps the result exact even when a
  customer id appears twice in the customer table.  Its keys contain those of
  the step before, so it adds no exchange.
* The price book is joined after aggregation (one lookup per group, not per
  record).  Seed rows are broadcast; a stored book is joined salted, as
  (plan, service) has a handful of values.
* Nothing here runs a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions import cdr as X
from tollgate.plans.joins import SALTS, join_dimension

ACTIVE = "active"
CONSUMPTION_KEYS = ("customer_id", "rate_plan_id", "record_type", "year_month")


def active_customers(customers: DataFrame) -> DataFrame:
    """customer_id and rate_plan_id of customers whose status is ``active``."""
    return customers.filter(F.col("status") == ACTIVE).select("customer_id", "rate_plan_id")


def cdr_with_plan(
    cdr: DataFrame,
    customers: DataFrame,
    time_zone: str = "UTC",
) -> DataFrame:
    """Per-record view: each stored record of an active customer with its
    plan, billing month and consumption units.

    This is a record-level join; a hot customer is split by AQE's skew-join
    handling (``spark.sql.adaptive.skewJoin.enabled``).  Rating itself does
    not go through this view (see ``monthly_consumption``).
    """
    dated = cdr.withColumn("year_month", X.billing_month("timestamp", time_zone))
    return join_dimension(dated, active_customers(customers), ["customer_id"]).withColumn(
        "consumption_units", X.consumption_units()
    )


def monthly_consumption(
    cdr: DataFrame,
    customers: DataFrame,
    time_zone: str = "UTC",
    month_col: str | None = None,
) -> DataFrame:
    """Sum of consumption units per customer, plan, service and month for
    active customers (inner join: unknown or inactive customers vanish).

    ``month_col`` names a column that already holds the billing month (the
    partition column of the stored records, written by
    ``normalise(..., with_month=True)``), which saves formatting the month
    from the timestamp for every record."""
    month = F.col(month_col) if month_col else X.billing_month("timestamp", time_zone)
    usage = (
        cdr.filter(F.col("customer_id").isNotNull())
        .select(
            "customer_id",
            "record_type",
            month.alias("year_month"),
            X.consumption_units().alias("units"),
        )
        .groupBy("customer_id", "record_type", "year_month")
        .agg(F.sum("units").alias("units"))
    )
    return (
        join_dimension(usage, active_customers(customers), ["customer_id"])
        .groupBy(*CONSUMPTION_KEYS)
        .agg(F.sum("units").alias("total_consumption_units"))
    )


def price(
    consumption: DataFrame,
    rates: DataFrame,
    decimal: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """Price monthly consumption: billable = units above the free allowance,
    cost = billable x unit price.  A service without a price row keeps its
    units, gets 0 billable and a null cost (left join).

    By default units, billable and cost are doubles, as in the source
    system.  ``decimal=True`` computes billable and cost in
    ``decimal(38, 6)`` (exact sums, independent of the summation order)."""
    # The book takes the usage's key names, so the join is on two names.
    book = rates.withColumnRenamed("service_type", "record_type").select(
        "rate_plan_id", "record_type", "unit_price", "free_units"
    )
    priced = join_dimension(
        consumption, book, ["rate_plan_id", "record_type"], "left", salts, salt_by=["customer_id", "year_month"]
    )
    if decimal:
        billable = X.billable_units_exact("total_consumption_units", "free_units")
        cost = X.money(billable * F.col("unit_price"))
    else:
        billable = X.billable_units("total_consumption_units", "free_units")
        cost = (billable * F.col("unit_price")).cast("double")
    return priced.select(
        "customer_id",
        "rate_plan_id",
        "record_type",
        "year_month",
        "total_consumption_units",
        "free_units",
        billable.alias("billable_units"),
        "unit_price",
        cost.alias("cost"),
    )


def rate_monthly(
    cdr: DataFrame,
    customers: DataFrame,
    rates: DataFrame,
    time_zone: str = "UTC",
    decimal: bool = False,
    month_col: str | None = None,
) -> DataFrame:
    """monthly_consumption then price: rows of ``monthly_rated_usage``."""
    return price(monthly_consumption(cdr, customers, time_zone, month_col), rates, decimal=decimal)


RUN_ID = "run_id"


def with_run(rated: DataFrame, run_id: int) -> DataFrame:
    """Tag rated usage with the id of the rating run that produced it (for
    append-only stores such as JDBC tables, where a month cannot be
    replaced in place)."""
    return rated.withColumn(RUN_ID, F.lit(run_id).cast("long"))


def latest_runs(rated: DataFrame, run_col: str = RUN_ID) -> DataFrame:
    """Rows of the latest rating run of each month: re-rating a month by
    appending a new run supersedes the earlier runs of that month only.

    The latest run per month is one row per month, which AQE broadcasts; the
    join is salted, so a month is not one task if it doesn't.  Rows without a
    month have their own latest run.
    """
    month = F.coalesce("year_month", F.lit("")).alias("_month")
    latest = rated.groupBy(month).agg(F.max(run_col).alias(run_col))
    marked = rated.withColumn("_month", month)
    return join_dimension(
        marked, latest, ["_month", run_col], "left_semi", SALTS, salt_by=["customer_id", "record_type"]
    ).drop("_month")
