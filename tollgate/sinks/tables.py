"""Parquet table sinks with idempotent write modes.

* Normalised records are stored partitioned by ``year_month`` so rating a
  month prunes every other month at the scan.
* Rated usage and bills replace the months asked for, a month without rows
  included, so a rerun leaves nothing stale; without months the table is
  overwritten.  ``append`` keeps the source system's behaviour, where a rerun
  duplicates rows.  ``atomic`` tables (:mod:`tollgate.versions`) change all their
  months in one step.
* Table writers for micro-batches overwrite ``batch_id=<n>``: a replayed batch
  replaces its own output.  A topic of files that a next hop *streams* is
  written by Spark's own file sink instead (``streaming.runners``): its log of
  committed files is what the file source trusts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate import storage
from tollgate.operators.mediation import encode
from tollgate.versions import MONTH, MonthTable

BatchSink = Callable[[DataFrame, int], None]

_CACHED = "_tollgate_cached"


def side_of_cached(side: DataFrame) -> DataFrame:
    """Mark a frame as projections and filters over a cached micro-batch (a side of
    a fan-out): a sink need not cache it again."""
    setattr(side, _CACHED, True)
    return side


def write_batch_once(batch: DataFrame, write: Callable[[DataFrame], None], skip_empty: bool = True) -> None:
    """Run ``write`` on a micro-batch, skipping it when empty.

    The batch is persisted for the emptiness check and the write, so the
    source is read once per batch and metrics observed in its plan count
    each row once.  A side of a fan-out, which persists the whole batch
    (:func:`side_of_cached`), is not cached again.
    """
    own_cache = not getattr(batch, _CACHED, False)
    if own_cache:
        batch.persist()
    try:
        if skip_empty and batch.isEmpty():
            return
        write(batch)
    finally:
        if own_cache:
            batch.unpersist()


def by_month(df: DataFrame) -> DataFrame:
    """Rows dealt by month, in partitions that AQE sizes from measured bytes:
    about one file per month, or several of a large one, instead of a file per
    task and month."""
    return df.hint("rebalance", MONTH)


def _month_files(spark, path: str, months: Iterable[str]) -> dict[str, list[str]]:
    return {m: storage.names(spark, f"{path}/{MONTH}={m}") for m in months}


def replace_months(df: DataFrame, path: str, months: Iterable[str] | None = None) -> None:
    """Make ``df`` the contents of ``months`` in a month-partitioned table; of
    the whole table when ``months`` is None.

    One job writes the months that have rows (dynamic overwrite).  A month asked
    for whose files are still those of before had none, and is replaced by an
    empty one; nothing of ``df`` runs again for it.  Rows of months not asked for are not
    written.  The months change one after another: a table whose readers must
    not see that is a :class:`~tollgate.versions.MonthTable`."""
    if months is None:
        by_month(df).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(MONTH).parquet(path)
        return
    spark, wanted = df.sparkSession, sorted(set(months))
    before = _month_files(spark, path, wanted)
    rows = df.filter(F.col(MONTH).isin(wanted))
    by_month(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    after = _month_files(spark, path, wanted)
    empty = spark.createDataFrame([], df.drop(MONTH).schema)
    for month in wanted:
        if before[month] == after[month]:  # a write names its files anew
            empty.write.mode("overwrite").parquet(f"{path}/{MONTH}={month}")


def write_rated(
    rated: DataFrame,
    path: str,
    mode: str = "replace_months",
    months: Iterable[str] | None = None,
    atomic: bool = False,
) -> None:
    """``replace_months`` replaces ``months`` (None: the table); ``append`` adds;
    ``overwrite`` replaces the table.  ``atomic`` (and any table written so before)
    changes all months in one step."""
    if mode not in ("replace_months", "append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    table = MonthTable(rated.sparkSession, path)
    if atomic or table.exists():
        if mode == "append":
            table.append(rated)
        else:
            table.replace(rated, months if mode == "replace_months" else None)
    elif mode == "append":
        by_month(rated).write.mode("append").partitionBy(MONTH).parquet(path)
    else:
        replace_months(rated, path, months if mode == "replace_months" else None)


def write_bills(bills: DataFrame, path: str, months: Iterable[str] | None = None, atomic: bool = False) -> None:
    """Replace the bills of ``months``; without months, all bills."""
    write_rated(bills, path, months=months, atomic=atomic)


def write_normalised(cdr: DataFrame, path: str, mode: str = "append", cluster_into: int | None = None) -> None:
    """Store normalised records partitioned by ``year_month`` (the frame must
    carry it: ``normalise(..., with_month=True)``).

    A backfill spanning many months would write one file per task and month.
    ``cluster_into=n`` range-partitions the records on (year_month,
    customer_id, timestamp) into ``n`` balanced tasks first, with boundaries
    from a sample.  A large month is split over many tasks, and the
    timestamp splits a subscriber holding a large share of the records.  The
    result is about ``n`` files, each a slice of one month ordered by
    customer, which also gives tight min/max statistics for customer
    filters.  Micro-batches (one month at a time) need none of it.
    """
    if cluster_into:
        keys = [c for c in ("year_month", "customer_id", "timestamp") if c in cdr.columns]
        cdr = cdr.repartitionByRange(cluster_into, *keys).sortWithinPartitions(*keys)
    cdr.write.mode(mode).partitionBy("year_month").parquet(path)


def batch_table_writer(
    path: str,
    partition_by: Iterable[str] = (),
    on_error: str = "raise",
    skip_empty: bool = True,
) -> BatchSink:
    """``foreachBatch`` callback writing each micro-batch to
    ``<path>/batch_id=<n>`` (overwrite, so a replay replaces it).

    With ``partition_by`` (e.g. ``year_month``) the layout is
    ``<path>/year_month=<m>/batch_id=<n>``: a month's batches stay together
    (read or compact one month by its folder), and a dynamic partition
    overwrite lets a replay replace exactly its own batch folders.

    ``on_error="raise"`` fails the query so the batch is replayed on restart;
    ``"skip"`` logs and drops the batch (the source system's behaviour: the
    checkpoint advances and the batch is lost).
    """
    parts = list(partition_by)

    def save(batch: DataFrame, batch_id: int) -> None:
        if not parts:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            return
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts, "batch_id")
            .parquet(path)
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        try:
            write_batch_once(batch, lambda b: save(b, batch_id), skip_empty)
        except Exception as exc:  # noqa: BLE001 - policy decides
            if on_error == "skip":
                print(f"batch {batch_id} dropped: {exc}")
                return
            raise

    return write


def batch_message_writer(path: str, skip_empty: bool = True) -> BatchSink:
    """``foreachBatch`` callback writing each micro-batch as JSON messages
    (one per line) to ``<path>/batch_id=<n>``, to be read as a batch.  Not for a
    stream that follows: a replayed batch gets new file names, which a file
    source takes as new messages (see :func:`tollgate.streaming.runners.run_mediation_streams`)."""

    def save(batch: DataFrame, batch_id: int) -> None:
        encode(batch).select("value").write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_once(batch, lambda b: save(b, batch_id), skip_empty)

    return write
