"""Primary keys of arriving batches: what a database does on insert.

A stateful processor keeps every key that was accepted, in a RocksDB store.  Of the
rows of a key that never came before, the first is accepted; all others, in the same
batch or later, are rejected as ``duplicate_key``, and a row with a null in its key
as ``null_key``.  The state is part of the checkpoint: a replayed batch meets the
state as it was before it, so it gives the same verdicts.

The first of several rows in one batch is the least by ``order``, then by all other
columns, so the verdict does not depend on how a batch was dealt.  A key's rows of one
batch are streamed through its task, one at a time; rows with a null key, which may be
many, are spread over ``NULL_SLOTS`` groups and need no state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tollgate.sinks.tables import BatchSink, side_of_cached
from tollgate.streaming.resent import rocksdb_state

REASON = "reject_reason"
NULL_KEY, DUPLICATE_KEY = "null_key", "duplicate_key"
NULL_SLOTS = 64
_SLOT = "_slot"


class FirstOfKey(StatefulProcessor):
    """Marks each row with the reason of its rejection, or null."""

    def __init__(self, columns: list[str], order: list[str]):
        rest = [c for c in columns if c not in order]
        self.columns, self.sort = columns, [*order, *rest]
        self.marked = Row(*columns, REASON)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getValueState("accepted", "known boolean")

    def _rank(self, row: Row) -> tuple:
        return tuple((row[c] is not None, row[c]) for c in self.sort)

    def _marked(self, row: Row, reason: str | None) -> Row:
        return self.marked(*[row[c] for c in self.columns], reason)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[-1] is not None:  # a slot of rows with a null key
            for row in rows:
                yield self._marked(row, NULL_KEY)
            return
        if self.accepted.exists():
            for row in rows:
                yield self._marked(row, DUPLICATE_KEY)
            return
        first = None
        for row in rows:
            if first is None:
                first = row
            elif self._rank(row) < self._rank(first):
                yield self._marked(first, DUPLICATE_KEY)
                first = row
            else:
                yield self._marked(row, DUPLICATE_KEY)
        if first is not None:
            self.accepted.update((True,))
            yield self._marked(first, None)

    def close(self) -> None:
        pass


def first_of_key(rows: DataFrame, keys: Iterable[str], order: Iterable[str] = ()) -> DataFrame:
    """The streaming ``rows`` with ``reject_reason``: null for the row that is the
    first of its primary key.  ``order`` and key columns must be of types that
    compare (not maps, structs or variants)."""
    keys = list(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    slot = F.when(missing, F.pmod(F.xxhash64(*rows.columns), F.lit(NULL_SLOTS)).cast("int"))
    marked = StructType([*rows.schema.fields, StructField(REASON, StringType(), True)])
    return (
        rows.withColumn(_SLOT, slot)
        .groupBy(*keys, _SLOT)
        .transformWithState(
            FirstOfKey(list(rows.columns), list(order)), outputStructType=marked, outputMode="Append", timeMode="None"
        )
    )


def run_key_check(
    rows: DataFrame,
    keys: Iterable[str],
    accepted: BatchSink,
    rejected: BatchSink,
    checkpoint: str,
    order: Iterable[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the check as one query: each batch is marked once and feeds both sides."""

    def both(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            accepted(side_of_cached(batch.filter(F.col(REASON).isNull()).drop(REASON)), batch_id)
            rejected(side_of_cached(batch.filter(F.col(REASON).isNotNull())), batch_id)
        finally:
            batch.unpersist()

    marked = first_of_key(rows, keys, order)
    writer = marked.writeStream.foreachBatch(both).outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    with rocksdb_state(rows.sparkSession):
        return writer.start()
