"""The batch chain over stored tables, as it runs in production.

* Normalised records are stored partitioned by ``year_month``.
* Rating reads only the months it rates: the month filter is a partition
  filter, so other months are never listed or read.  The months asked for are
  replaced in the rated-usage table, those that have no rows any more included.
* Billing reads the rated months back and replaces the bills of those
  months only.

Each step writes a table, which also cuts the lineage between steps: a lost
executor recomputes from the last written table, not from the raw records.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.billing import bill_monthly
from tollgate.operators.rating import rate_monthly
from tollgate.sinks.tables import MONTH, write_bills, write_normalised, write_rated
from tollgate.sources.files import read_table
from tollgate.versions import MonthTable


def store_normalised(
    cdr_with_month: DataFrame, path: str, mode: str = "append", cluster_into: int | None = None
) -> None:
    """Write normalised records (``normalise(..., with_month=True)``); see
    :func:`tollgate.sinks.tables.write_normalised` for ``cluster_into``."""
    write_normalised(cdr_with_month, path, mode, cluster_into)


def stored_months(spark: SparkSession, path: str, months: Iterable[str] | None = None) -> DataFrame:
    """Rows of ``months`` of a month-partitioned table (all when None).  Records
    without a time live in the null month and are read only with all."""
    table = MonthTable(spark, path)
    if table.exists():
        return table.read(months)
    df = read_table(spark, path)
    if months is not None:
        df = df.filter(F.col(MONTH).isin(list(months)))
    return df


def rate_stored(
    spark: SparkSession,
    cdr_path: str,
    customers: DataFrame,
    rates: DataFrame,
    rated_path: str,
    months: Iterable[str] | None = None,
    atomic: bool = False,
    **rating_options,
) -> DataFrame:
    """Rate the stored months and replace them in the rated-usage table;
    returns the rated rows as read back from the table.  ``atomic``: all months change
    in one step (:mod:`tollgate.versions`)."""
    month_list = None if months is None else list(months)
    cdr = stored_months(spark, cdr_path, month_list)
    # the stored partition column is the billing month: no per-record formatting
    rated = rate_monthly(cdr, customers, rates, month_col=MONTH, **rating_options)
    write_rated(rated, rated_path, months=month_list, atomic=atomic)
    return stored_months(spark, rated_path, month_list)


def bill_stored(
    rated: DataFrame, bills_path: str, months: Iterable[str] | None = None, atomic: bool = False, **bill_options
) -> DataFrame:
    """Bills of the given rated rows.  They replace the bills of ``months``, the
    others are kept; without months, they replace all bills."""
    month_list = None if months is None else list(months)
    if month_list is not None:
        rated = rated.filter(F.col(MONTH).isin(month_list))
    bills = bill_monthly(rated, **bill_options)
    write_bills(bills, bills_path, month_list, atomic)
    return bills
