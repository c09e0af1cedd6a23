"""JDBC table sink.

``append`` creates a missing table from the frame schema.  ``overwrite``
drops and recreates the table unless ``truncate`` keeps its definition.
Credentials come from ``properties`` supplied by the caller.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ID = "batch_id"


def jdbc_write_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    truncate: bool = False,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), "truncate": str(truncate).lower()}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    opts.update(properties or {})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **kwargs)).mode(mode).save()


#: SQL states by which databases say that a table does not exist (fixed values).
NO_SUCH_TABLE = ("42P01", "42S02", "42X05", "42704")


def sql_state(error: BaseException) -> str | None:
    """The SQL state of the database error behind an exception of Spark's."""
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while java is not None:
        try:
            return java.getSQLState()
        except Exception:  # noqa: BLE001 - not an SQL exception: look at its cause
            pass
        try:
            java = java.getCause()
        except Exception:  # noqa: BLE001
            return None
    return None


def _written_keys(batch: DataFrame, url: str, table: str, properties: dict[str, str] | None, keys: list[str]):
    """Keys in ``table`` within the batch's range of the last key (an offset;
    the range is pushed to the database), or None when the table does not exist
    yet.  Any other error is raised: a batch whose written rows are not known
    must not be appended."""
    from tollgate.sources.jdbc import read_jdbc

    try:
        existing = read_jdbc(batch.sparkSession, url, table, properties=properties)
    except Exception as error:  # noqa: BLE001 - only a missing table passes
        if sql_state(error) in NO_SUCH_TABLE:
            return None
        raise
    span = batch.dropna(subset=keys).agg(F.min(keys[-1]).alias("low"), F.max(keys[-1]).alias("high")).first()
    return existing.filter(F.col(keys[-1]).between(span["low"], span["high"])).select(*keys).distinct()


def jdbc_batch_writer(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    key_columns: tuple[str, ...] = (),
    on_error: str = "raise",
    skip_empty: bool = True,
    num_partitions: int | None = None,
):
    """``foreachBatch`` callback appending each micro-batch to a JDBC table.

    Without ``key_columns`` delivery is at-least-once: a replayed batch is
    appended again.  With ``key_columns`` that identify a message, ending in an
    offset (the raw message's topic, partition and offset, carried in it), rows
    also carry ``batch_id``; before appending, the keys already in the table are
    read back for the batch's range of offsets and anti-joined, so a replay of a
    batch that failed half-way, or a message sent again in a later batch, adds
    only missing rows: exactly-once contents.  A row with a null key names no
    message: it is equal to no other row and always appended, at least once
    (``run_store`` gives such messages their own coordinates).

    ``on_error="skip"`` logs and drops a failed batch (the source system's
    behaviour); the default raises so the query stops and replays it.
    """
    keys = list(key_columns)

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if keys:
            whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
            named = batch.filter(whole).dropDuplicates(keys)
            done = _written_keys(batch, url, table, properties, keys)
            if done is not None:
                named = named.join(done, keys, "left_anti")
            rows = named.select(*batch.columns).unionByName(batch.filter(~whole))
            rows = rows.withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
        write_jdbc(rows, url, table, mode="append", properties=properties, num_partitions=num_partitions)

    def write(batch: DataFrame, batch_id: int) -> None:
        from tollgate.sinks.tables import write_batch_once

        try:
            write_batch_once(batch, lambda b: save(b, batch_id), skip_empty)
        except Exception as exc:  # noqa: BLE001 - policy decides
            if on_error == "skip":
                print(f"batch {batch_id} dropped: {exc}")
                return
            raise

    return write
