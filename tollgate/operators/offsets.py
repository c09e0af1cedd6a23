"""What a topic lost: gaps between the offsets that were stored.

A stream that goes on after data loss (``failOnDataLoss=false``) says nothing of the
messages it never saw.  Their offsets are missing from the stored (topic, partition,
offset) coordinates.  Stored offsets are kept as *islands*, runs ``[first, last]``
without a hole; sets of islands merge, so each batch adds its own, and the gaps are what
lies between a partition's islands.

One topic partition may hold a third of all messages: everything runs within slices of
``SLICE`` consecutive offsets, at whose edges islands are cut, so no task sorts more than
a slice of one partition.  Only a row per slice, its first and last offset, meets the
partition's other slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COORDINATES = ("topic", "partition")
SLICE = 1 << 16
_SLICED = [*COORDINATES, "_slice"]


def _slice_of(offset: str):
    return F.floor(F.col(offset) / SLICE)


def _sliced(runs: DataFrame) -> DataFrame:
    """Runs cut at the edges of slices."""
    slices = F.explode(F.sequence(_slice_of("first"), _slice_of("last"))).alias("_slice")
    return runs.select(*COORDINATES, "first", "last", slices).select(
        *_SLICED,
        F.greatest("first", F.col("_slice") * SLICE).alias("first"),
        F.least("last", (F.col("_slice") + 1) * SLICE - 1).alias("last"),
    )


def _joined(runs: DataFrame) -> DataFrame:
    """Runs of a slice that touch or overlap, joined."""
    order = Window.partitionBy(*_SLICED).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    island = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        runs.withColumn("_begins", begins)
        .withColumn("_island", island)
        .groupBy(*_SLICED, "_island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("_island")
    )


def islands(messages: DataFrame) -> DataFrame:
    """``topic, partition, first, last``: the runs of the stored offsets, cut at the edges
    of slices.  Repeated messages count once; rows with a null coordinate name no message."""
    named = messages.select(*COORDINATES, F.col("offset").cast("long").alias("first")).dropna()
    once = named.distinct()  # combines map-side
    return _joined(once.withColumn("last", F.col("first")).withColumn("_slice", _slice_of("first"))).drop("_slice")


def merge_islands(runs: DataFrame) -> DataFrame:
    """Islands of any origin (batches, other cuts), merged within slices."""
    return _joined(_sliced(runs.select(*COORDINATES, "first", "last"))).drop("_slice")


def gaps(runs: DataFrame) -> DataFrame:
    """``topic, partition, first, last, n_lost``: each run of offsets that is missing
    between a partition's first and last island.  (Transaction markers and compacted
    messages of a topic use up offsets too.)"""
    merged = _joined(_sliced(runs.select(*COORDINATES, "first", "last")))
    after = F.lead("first").over(Window.partitionBy(*_SLICED).orderBy("first"))
    inside = merged.select(*COORDINATES, "last", after.alias("next"))
    edges = merged.groupBy(*_SLICED).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    following = F.lead("first").over(Window.partitionBy(*COORDINATES).orderBy("first"))  # a row per slice
    across = edges.select(*COORDINATES, "last", following.alias("next"))
    return (
        inside.unionByName(across)
        .filter(F.col("next") > F.col("last") + 1)
        .select(*COORDINATES, (F.col("last") + 1).alias("first"), (F.col("next") - 1).alias("last"))
        .withColumn("n_lost", F.col("last") - F.col("first") + 1)
    )
