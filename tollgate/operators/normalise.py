"""Normalisation of valid mediated records into the storage table shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tollgate.functions import cdr as X


def normalise(
    mediated: DataFrame,
    with_month: bool = False,
    time_zone: str = "UTC",
    observe: str | Observation | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Valid mediated records -> ``cdr_records_normalized`` rows.

    customer_id is ``+`` and the subscriber number when it is a domestic
    number, otherwise the row is dropped; the peer becomes receiver (sms,
    voice) and callee (voice); missing duration / volume become 0; the data
    session length stays in ``duration_sec`` and ``session_duration_sec`` is 0;
    unparseable time becomes null.

    One projection and one filter (pushed below the projection by Catalyst).
    ``with_month`` appends ``year_month`` for month-partitioned storage.

    ``observe`` (an ``Observation`` in batch, a metric name in a stream)
    counts, as the rows flow, the valid records (``valid_rows``) and those
    dropped for not being a customer number (``dropped_rows``); the source
    system drops them without a trace.

    ``keep`` appends input columns after the storage columns, e.g. the
    message coordinates (topic, partition, offset) that key an exactly-once
    JDBC sink.
    """
    cols = [
        F.col("record_type").cast("string").alias("record_type"),
        F.concat(F.lit(X.CUSTOMER_ID_PREFIX), F.col("msisdn")).cast("string").alias("customer_id"),
        F.col("cell_id").cast("string").alias("cell_id"),
        F.col("technology").cast("string").alias("technology"),
        X.receiver_of().cast("string").alias("receiver_id"),
        X.callee_of().cast("string").alias("callee_id"),
        F.coalesce(F.col("duration").cast("long"), F.lit(0).cast("long")).alias("duration_sec"),
        F.coalesce(F.col("volume_mb").cast("double"), F.lit(0.0)).alias("data_volume_mb"),
        F.lit(0).cast("long").alias("session_duration_sec"),
        X.event_time("timestamp").cast("timestamp").alias("timestamp"),
    ]
    # The customer-number test is the filter itself, so the pattern is
    # matched once per record; rows that pass get the ``+`` id (the same
    # rows and values as ``customer_id_of`` followed by a not-null filter).
    valid = mediated.filter(F.col("status") == "valid")
    if observe is not None:
        valid = valid.observe(
            observe,
            F.count(F.lit(1)).alias("valid_rows"),
            F.count(F.when(X.customer_id_of("msisdn").isNull(), 1)).alias("dropped_rows"),
        )
    out = valid.filter(X.is_customer_number("msisdn")).select(*cols, *keep)
    if with_month:
        out = out.withColumn("year_month", X.billing_month("timestamp", time_zone))
    return out
