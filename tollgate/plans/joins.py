"""Joins against dimension tables, without a job at planning time.

A dimension is broadcast only when its size is bounded by construction: its
rows are held in the plan itself (seed rows, ``VALUES``).  Any other dimension
is left to Catalyst and AQE, which may broadcast a side whose finished shuffle
stage measures under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Where
the join key has few values (plan and service, month, nation), the join is
salted, so that no task holds all facts of one value either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows in the plan up to which a dimension is broadcast.
MAX_PLAN_ROWS = 100_000
#: Parts that the facts of one key value are dealt to in a salted join.
SALTS = 32
_SALT = "_salt"


def plan_rows(df: DataFrame) -> int | None:
    """Exact row count of a frame whose rows are held in the plan itself
    (``createDataFrame`` of a list, ``VALUES``), else None.  Runs no job."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        if plan.getClass().getSimpleName() == "LocalRelation":
            return int(plan.data().size())
    except Exception:  # noqa: BLE001 - e.g. a remote session: size unknown
        pass
    return None


def bounded(df: DataFrame, max_rows: int = MAX_PLAN_ROWS) -> bool:
    rows = plan_rows(df)
    return rows is not None and rows <= max_rows


def hold(df: DataFrame, max_rows: int = MAX_PLAN_ROWS) -> DataFrame:
    """``df`` with its rows held in the plan, if there are at most ``max_rows``: what
    is joined with it later broadcasts it with a known size.  A larger frame comes back
    as it is.  Runs one job that reads ``max_rows + 1`` rows at most: for jobs that
    start from a stored price book or name table, not for operators."""
    if bounded(df, max_rows):
        return df
    rows = df.limit(max_rows + 1).toArrow()
    return df if rows.num_rows > max_rows else df.sparkSession.createDataFrame(rows, schema=df.schema)


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: list[str],
    how: str = "inner",
    salts: int = 1,
    salt_by: list[str] | None = None,
) -> DataFrame:
    """Join facts with a dimension on equally named columns.

    ``salts`` above 1 is for keys with few values: the dimension is repeated
    ``salts`` times and each fact meets one copy, picked by a hash of
    ``salt_by`` (all fact columns by default).  Not used when the dimension is
    broadcast."""
    if bounded(dimension):
        return facts.join(F.broadcast(dimension), on, how)
    if salts <= 1:
        return facts.join(dimension, on, how)
    copies = dimension.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(*(salt_by or facts.columns)), F.lit(salts)).cast("int")
    return facts.withColumn(_SALT, salt).join(copies, [*on, _SALT], how).drop(_SALT)
