"""Records sent again are stored, and billed, once (opt-in; by default a record
counts as often as it comes, as in the source system).

A record's identity is all its stored columns.  A stream keeps the identities it has
seen in keyed state, which the watermark bounds: a copy that comes within ``bound``
of the first one is dropped, and the state of a record is dropped once the watermark
has passed it by ``bound``.  The state is checkpointed with the offsets, so a
restarted stream still knows what it has seen.

Which clock:

* ``event_time="timestamp"``, the record's own time.  A record that comes later than
  ``bound`` behind the newest one is dropped by the watermark, copy or not;
  :func:`late_rows` counts them.
* an arrival time (a topic's message time, a file's modification time).  Nothing is
  late then, however old the record; the bound is how long after a record its copy may come.

Records without a time are never taken for copies.  Defined the same way in batch.
The identities are hashed over the cluster: no key is hot unless one record itself is
sent millions of times.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tollgate.schemas import NORMALISED_CDR

RECORD_IDENTITY = tuple(NORMALISED_CDR.names)
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: on the executors' disks
    with changes checkpointed, so it may outgrow their memory."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def without_resent(
    rows: DataFrame,
    bound: str,
    identity: Iterable[str] = RECORD_IDENTITY,
    event_time: str = "timestamp",
    always_timed: bool = False,
) -> DataFrame:
    """``rows`` without copies that come within ``bound``.  A batch frame drops every
    copy.  ``always_timed`` says that ``event_time`` is never null (an arrival time),
    which saves reading the stream a second time for the rows without one."""
    keys = list(identity)
    timed = rows if always_timed else rows.filter(F.col(event_time).isNotNull())
    if rows.isStreaming:
        once = timed.withWatermark(event_time, bound).dropDuplicatesWithinWatermark(keys)
    else:
        once = timed.dropDuplicates(keys)
    return once if always_timed else once.unionByName(rows.filter(F.col(event_time).isNull()))


def late_rows(query: StreamingQuery) -> int:
    """Records that the watermark has dropped so far as too late (out of the
    progress reports that the query still holds)."""
    return sum(
        int(state["numRowsDroppedByWatermark"]) for p in query.recentProgress for state in p["stateOperators"]
    )
