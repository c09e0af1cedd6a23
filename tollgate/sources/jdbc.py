"""JDBC table source with an optional partitioned read.

Without bounds a JDBC scan is one task; give ``partition_column`` (numeric,
date or timestamp) with bounds and ``num_partitions`` to read in parallel.
Credentials come from ``properties`` supplied by the caller.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_read_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update(properties or {})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kwargs)).load()


def read_jdbc_split(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A parallel JDBC scan over ``num_partitions`` ranges of a numeric or
    date ``column``, with the bounds read first from the database (a
    ``MIN``/``MAX`` aggregate, pushed down where the database's dialect
    supports it, else computed over that one column).
    Rows outside or at the bounds are still read: the bounds only place the
    range boundaries."""
    opts = jdbc_read_options(url, table, properties)
    opts["pushDownAggregate"] = "true"
    bounds = (
        spark.read.format("jdbc").options(**opts).load()
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        .first()
    )
    if bounds is None or bounds["lo"] is None:
        return read_jdbc(spark, url, table, properties=properties)
    lo, hi = bounds["lo"], bounds["hi"]
    if isinstance(lo, (int, float, Decimal)):
        # numeric bounds are read as whole numbers: widen to the enclosing ones
        lo, hi = math.floor(lo), math.ceil(hi)
    else:
        lo, hi = str(lo), str(hi)  # date / timestamp literals
    return read_jdbc(
        spark, url, table, properties=properties, partition_column=column,
        lower_bound=lo, upper_bound=hi, num_partitions=num_partitions,
    )


def quantile_query(table: str, column: str, num_partitions: int) -> str:
    """The query that gives the least value of each of ``num_partitions`` ranges with
    equally many rows: one pass in the database, a row per range."""
    tiles = (
        f"SELECT {column} AS bound, NTILE({int(num_partitions)}) OVER (ORDER BY {column}) AS tile "
        f"FROM {table} WHERE {column} IS NOT NULL"
    )
    return f"(SELECT MIN(bound) AS bound FROM ({tiles}) tiles GROUP BY tile) bounds"


def _literal(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, Decimal, float)):
        return "'" + str(value).replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, bounds: Iterable) -> list[str]:
    """``WHERE`` predicates of the ranges that begin at the given values: each row is
    in exactly one.  The first range has what lies below it, and the nulls.  A value that
    begins several ranges (a key with very many rows) begins one."""
    starts = sorted(set(b for b in bounds if b is not None))[1:]
    if not starts:
        return ["1 = 1"]
    first = f"{column} < {_literal(starts[0])} OR {column} IS NULL"
    between = [f"{column} >= {_literal(a)} AND {column} < {_literal(b)}" for a, b in zip(starts, starts[1:])]
    return [first, *between, f"{column} >= {_literal(starts[-1])}"]


def read_jdbc_balanced(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    num_partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A parallel JDBC scan over ranges of ``column`` that hold equally many rows, however
    its values are spread (numbers, dates, times or strings): the boundaries are quantiles
    that the database computes in one query.  Ranges of equal width
    (:func:`read_jdbc_split`) put most rows of a skewed column in one task.  Rows that
    arrive after the boundaries were read are read too."""
    bounds = read_jdbc(spark, url, quantile_query(table, column, num_partitions), properties=properties)
    found = [r[0] for r in bounds.collect()]  # a row per range
    return read_jdbc_predicates(spark, url, table, range_predicates(column, found), properties)


def read_jdbc_predicates(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A parallel JDBC scan with one task per ``WHERE`` predicate, for keys
    that are not numeric (e.g. ``customer_id LIKE '%0'`` ... ``'%9'``).  The
    predicates must cover every row exactly once."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties or {}))
