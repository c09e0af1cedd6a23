"""Streaming hops.

Hop 1 (mediation): messages -> decode -> unify -> validate -> valid and
invalid sinks.  Hop 2 (store): valid messages -> decode -> normalise -> table.
Both hops are stateless map/filter queries (no watermark, no state store);
their progress lives in the checkpoint, so a restarted query resumes after
the last committed batch.

Hop 1 runs as one query that reads the source once and feeds both sides
(``run_mediation``), or as two queries with a sink and checkpoint each
(``run_mediation_streams``).  A topic of files takes the second form: Spark's
file sink logs what a batch committed and the file source reads only that, so
a replayed batch is seen once by hop 2.  Over Kafka a replayed batch is sent
again; the messages carry the raw message's coordinates, by which hop 2's
keyed sink knows them.
"""

from __future__ import annotations

from contextlib import nullcontext
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tollgate.operators.mediation import decode, encode, mediate, split
from tollgate.operators.normalise import normalise
from tollgate.operators.reasons import BAD, decode_with_reasons
from tollgate.schemas import MEDIATED_CDR, RAW_CDR
from tollgate.sinks.tables import BatchSink, side_of_cached
from tollgate.streaming.resent import rocksdb_state, without_resent


def _start(writer, trigger: dict | None) -> StreamingQuery:
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


#: What dead letters carry besides the record: the message text, and what is wrong in it.
_DEAD_LETTERS_ONLY = ("raw_value", BAD)


def _decoded(messages: DataFrame, value_col: str, keep: tuple[str, ...], keep_raw: bool, reasons: bool) -> DataFrame:
    if reasons:
        return decode_with_reasons(messages, RAW_CDR, value_col, keep=keep)
    return decode(messages, RAW_CDR, value_col, keep=keep, keep_raw=keep_raw)


def mediation_fanout(valid_sink: BatchSink, invalid_sink: BatchSink) -> BatchSink:
    """One ``foreachBatch`` callback feeding both sides from a single read of
    the source: the batch is cached once, split, written twice."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, invalid = split(batch)
            valid_sink(side_of_cached(valid.drop(*_DEAD_LETTERS_ONLY)), batch_id)
            invalid_sink(side_of_cached(invalid), batch_id)
        finally:
            batch.unpersist()

    return run


def run_mediation(
    messages: DataFrame,
    valid_sink: BatchSink,
    invalid_sink: BatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    value_col: str = "value",
    keep: tuple[str, ...] = (),
    keep_raw: bool = False,
    reject: tuple[str, ...] = (),
    reasons: bool = False,
) -> StreamingQuery:
    """Start hop 1 as one query with a fan-out (the source is read once).

    ``keep`` carries source columns (topic, partition, offset) to both
    sides, ``keep_raw`` keeps the message text (``raw_value``) for dead
    letters, ``reasons`` also says what is wrong in it (``bad_fields``, see
    :mod:`tollgate.operators.reasons`), and ``reject`` names strict validation rules (see
    :func:`tollgate.operators.mediation.validate`)."""
    validated = mediate(_decoded(messages, value_col, keep, keep_raw, reasons), reject)
    writer = (
        validated.writeStream.foreachBatch(mediation_fanout(valid_sink, invalid_sink))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, trigger)


def mediation_streams(
    messages: DataFrame,
    value_col: str = "value",
    keep: tuple[str, ...] = (),
    keep_raw: bool = False,
    reject: tuple[str, ...] = (),
    reasons: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Hop 1 as two streaming frames (valid, invalid) for two queries with
    their own sinks and checkpoints; each query reads the source itself."""
    return split(mediate(_decoded(messages, value_col, keep, keep_raw, reasons), reject))


def run_mediation_streams(
    messages: DataFrame,
    valid: str | BatchSink,
    invalid: str | BatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> list[StreamingQuery]:
    """Start hop 1 as two queries.  A side given as a path is written by the file
    sink (valid: JSON messages, one per line; invalid: parquet), a callable gets
    micro-batches.  ``options`` are those of :func:`mediation_streams`.  Each
    query has its own folder under ``checkpoint``."""
    good, bad = mediation_streams(messages, **options)
    good = good.drop(*_DEAD_LETTERS_ONLY)
    queries = []
    for name, frame, side in (("valid", good, valid), ("invalid", bad, invalid)):
        if callable(side):
            writer = frame.writeStream.foreachBatch(side)
        elif name == "valid":
            writer = encode(frame).select("value").writeStream.format("text").option("path", side)
        else:
            writer = frame.writeStream.format("parquet").option("path", side)
        queries.append(_start(writer.outputMode("append").option("checkpointLocation", f"{checkpoint}/{name}"), trigger))
    return queries


#: Seconds between looks at the other queries while one is waited for.
POLL_SECONDS = 0.2


def wait_any(spark: SparkSession, queries: list[StreamingQuery], until_all: bool = False) -> None:
    """Wait until any of the queries ends, and stop the others; raise what ended
    it.  ``until_all`` lets those that end well go on to the last (queries that
    process what is there and stop).

    Only the given queries are looked at.  The session's own list of ended
    queries is neither read nor reset: another query that fails is its owner's."""
    left = list(queries)
    try:
        while left:
            active = [q.isActive for q in left]
            ended = [q for q, on in zip(left, active) if not on]
            for q in ended:
                if q.exception() is not None:
                    raise q.exception()
            left = [q for q, on in zip(left, active) if on]
            if ended and not until_all:
                return
            if left:
                left[0].awaitTermination(POLL_SECONDS)
    finally:
        for q in left:
            q.stop()


def keyed(rows: DataFrame, message_keys: tuple[str, ...], own_keys: tuple[str, ...]) -> DataFrame:
    """``message_keys`` where all of them are set, else all of ``own_keys``."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in message_keys])
    return rows.withColumns(
        {k: F.when(whole, F.col(k)).otherwise(F.col(own)) for k, own in zip(message_keys, own_keys, strict=True)}
    )


def run_store(
    messages: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    trigger: dict | None = None,
    value_col: str = "value",
    with_month: bool = False,
    observe: str | None = None,
    keep: tuple[str, ...] = (),
    schema: StructType = MEDIATED_CDR,
    message_keys: tuple[str, ...] = (),
    own_keys: tuple[str, ...] = (),
    resent_within: str | None = None,
    arrival: str | None = None,
) -> StreamingQuery:
    """Start hop 2: valid messages -> normalised rows -> ``sink`` per batch.

    ``observe`` names a metric set reported in each batch's progress
    (``observedMetrics``): valid rows and rows dropped as non-customers.
    ``keep`` carries source columns through to the sink, ``message_keys`` fields
    of the message itself (of ``schema``, e.g. the raw coordinates of
    ``schemas.KEYED_CDR``), for :func:`tollgate.sinks.jdbc.jdbc_batch_writer` keys.
    A message without all of them (of another producer, or sent before they were
    carried) is keyed by ``own_keys``, the source columns in the same order that
    identify the message itself.

    ``resent_within`` (e.g. ``"7 days"``) drops a record that comes again within that
    time (:func:`tollgate.streaming.resent.without_resent`), by the record's own time, or
    by ``arrival``, a kept source column that is never null.  By default a record is
    stored as often as it comes."""
    if arrival and arrival not in keep:
        raise ValueError(f"arrival column {arrival!r} must be among the kept ones")
    decoded = decode(messages, schema, value_col, keep=(*keep, *(k for k in own_keys if k not in keep)))
    if own_keys:
        decoded = keyed(decoded, message_keys, own_keys)
    rows = normalise(decoded, with_month=with_month, observe=observe, keep=(*keep, *message_keys))
    if resent_within:
        rows = without_resent(rows, resent_within, event_time=arrival or "timestamp", always_timed=arrival is not None)
    writer = rows.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    with rocksdb_state(rows.sparkSession) if resent_within else nullcontext():
        return _start(writer, trigger)
