"""Consumption and rated usage kept up to date batch by batch.

Rating a month again whenever records arrive, or arrive late, reads all its records
again.  Here a micro-batch of stored records is summed once, by (customer, service,
month), into a *delta* of partial sums; partial sums merge, so a month's consumption is
the sum of its deltas.  Only the keys that a batch touched are priced again; the newest
version of a key supersedes the older ones.

* ``usage``: layers of (customer, service, month, units, n_records), which add up;
* ``rated``: layers of priced rows, of which a key's newest count.  A touched key whose
  customer is not active (any more) gets a row that says so (``active`` false).

A layer is written under ``batch_id=<n>``: a replayed batch replaces its own layer.  The
layers are narrow and small beside the records; :meth:`Layers.fold` merges old ones into
a base whose commit file also says up to which batch it goes, so that a reader never
sees a layer twice or not at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tollgate import storage
from tollgate.functions import cdr as X
from tollgate.operators.mediation import decode
from tollgate.operators.normalise import normalise
from tollgate.operators.rating import CONSUMPTION_KEYS, active_customers, price
from tollgate.plans.joins import join_dimension
from tollgate.schemas import MEDIATED_CDR, RATED_USAGE
from tollgate.sinks.tables import batch_table_writer
from tollgate.versions import MONTH, MonthTable

USAGE_KEYS = ("customer_id", "record_type", MONTH)
BATCH = "batch_id"
_USAGE = StructType(
    [
        StructField("customer_id", StringType()),
        StructField("record_type", StringType()),
        StructField("units", RATED_USAGE["total_consumption_units"].dataType),
        StructField("n_records", LongType()),
        StructField(MONTH, StringType()),
        StructField(BATCH, LongType()),
    ]
)
_PRICED = StructType(
    [
        *[f for f in RATED_USAGE.fields if f.name != MONTH],
        StructField("active", BooleanType()),
        StructField(MONTH, StringType()),
        StructField(BATCH, LongType()),
    ]
)


def partial_usage(cdr: DataFrame) -> DataFrame:
    """Partial sums of stored records (with ``year_month``) by customer, service and
    month.  A customer with a third of the records is one row per task before the shuffle."""
    return (
        cdr.filter(F.col("customer_id").isNotNull())
        .select(*USAGE_KEYS, X.consumption_units().alias("units"))
        .groupBy(*USAGE_KEYS)
        .agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("n_records"))
    )


def merged(usage: DataFrame) -> DataFrame:
    """Partial sums added up by key."""
    return usage.groupBy(*USAGE_KEYS).agg(F.sum("units").alias("units"), F.sum("n_records").alias("n_records"))


def newest(priced: DataFrame) -> DataFrame:
    """The rows of each key's newest batch."""
    last = F.max(BATCH).over(Window.partitionBy(*USAGE_KEYS))
    return priced.withColumn("_last", last).filter(F.col(BATCH) == F.col("_last")).drop("_last")


class Layers:
    """A table of month-partitioned layers, one per batch, over a folded base."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, combine: Callable[[DataFrame], DataFrame]):
        self.spark, self.schema, self.combine = spark, schema, combine
        self.path, self.base = f"{path}/layers", MonthTable(spark, f"{path}/base")
        self._write = batch_table_writer(self.path, partition_by=(MONTH,))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self._write(rows, batch_id)

    def folded(self) -> int:
        """The last batch that the base holds; -1 when there is none."""
        return int(self.base.commit_of()["note"].get("upto", -1))

    def _layers(self) -> DataFrame:
        if not storage.names(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def layer(self, batch_id: int) -> DataFrame:
        return self._layers().filter(F.col(BATCH) == batch_id)

    def rows(self, months: Iterable[str | None] | None = None, upto: int | None = None) -> DataFrame:
        """Base and layers as they are, up to a batch; of ``months`` only (partition
        filters: other months are not read)."""
        wanted = None if months is None else set(months)
        entry = self.base.commit_of()  # one version for both reads
        layers = self._layers().filter(F.col(BATCH) > int(entry["note"].get("upto", -1)))
        if upto is not None:
            layers = layers.filter(F.col(BATCH) <= upto)
        layers = _of_months(layers, wanted)
        if not entry["version"]:
            return layers
        base = _of_months(self.base.read(version=entry["version"]), wanted)
        return layers.unionByName(base.select(*self.schema.names))

    def fold(self, upto: int) -> None:
        """Merge the base and the layers up to a batch into a new base.  ``upto`` must be
        a batch that the stream has committed, as it won't be written again."""
        if upto <= self.folded():
            return
        rows = self.combine(self.rows(upto=upto))
        if BATCH not in rows.columns:
            rows = rows.withColumn(BATCH, F.lit(upto).cast("long"))
        self.base.replace(rows.select(*self.schema.names), note={"upto": upto})

    def vacuum(self) -> int:
        """Remove the layers that the base holds; returns how many folders.  Not while a
        reader of before the last fold is still at work."""
        gone = 0
        for month in storage.names(self.spark, self.path):
            for layer in storage.names(self.spark, f"{self.path}/{month}"):
                if layer.startswith(f"{BATCH}=") and int(layer.partition("=")[2]) <= self.folded():
                    storage.remove(self.spark, f"{self.path}/{month}/{layer}")
                    gone += 1
        return gone


def _of_months(df: DataFrame, wanted: set | None) -> DataFrame:
    if wanted is None:
        return df
    named = F.col(MONTH).isin(sorted(m for m in wanted if m is not None))
    return df.filter(named | F.col(MONTH).isNull() if None in wanted else named)


class UsageStore:
    """Partial sums and priced keys under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.usage = Layers(spark, f"{path}/usage", _USAGE, merged)
        self.priced = Layers(spark, f"{path}/rated", _PRICED, newest)

    def add(self, cdr: DataFrame, batch_id: int) -> None:
        """Store the partial sums of a batch of records."""
        self.usage.write(partial_usage(cdr), batch_id)

    def consumption(self, months: Iterable[str] | None = None) -> DataFrame:
        """Units and records of every key so far (of all customers)."""
        return merged(self.usage.rows(months))

    def rerate(self, batch_id: int, customers: DataFrame, rates: DataFrame, **price_options) -> None:
        """Price the keys that a batch touched, from all sums up to it."""
        mine = self.usage.layer(batch_id)
        months = [r[0] for r in mine.select(MONTH).distinct().collect()]  # a row per month
        if not months:
            return
        touched = _of_months(mine, set(months)).select(*[F.col(k).alias(f"_{k}") for k in USAGE_KEYS]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in USAGE_KEYS]
        sums = merged(self.usage.rows(months, upto=batch_id).join(touched, same, "left_semi"))
        planned = join_dimension(
            sums, active_customers(customers).withColumn("active", F.lit(True)), ["customer_id"], "left"
        )
        active = (
            planned.filter("active").groupBy(*CONSUMPTION_KEYS).agg(F.sum("units").alias("total_consumption_units"))
        )
        rated = price(active, rates, **price_options).withColumn("active", F.lit(True))
        gone = planned.filter(F.col("active").isNull()).select(*USAGE_KEYS, F.lit(False).alias("active"))
        columns = [f.name for f in _PRICED.fields if f.name != BATCH]
        rows = rated.unionByName(gone, allowMissingColumns=True)
        self.priced.write(rows.select(*[F.col(c).cast(_PRICED[c].dataType).alias(c) for c in columns]), batch_id)

    def rated(self, months: Iterable[str] | None = None) -> DataFrame:
        """Rated usage as it stands: the rows of ``monthly_rated_usage``."""
        return newest(self.priced.rows(months)).filter("active").select(*RATED_USAGE.names)

    def fold(self, upto: int) -> None:
        self.usage.fold(upto)
        self.priced.fold(upto)


def run_usage(
    messages: DataFrame,
    store: UsageStore,
    customers: Callable[[], DataFrame],
    rates: Callable[[], DataFrame],
    checkpoint: str,
    trigger: dict | None = None,
    value_col: str = "value",
) -> StreamingQuery:
    """Start a stream of valid messages into the store: each batch is summed, and the
    keys it touched are priced with the customers and prices of that moment."""

    def save(batch: DataFrame, batch_id: int) -> None:
        store.add(batch, batch_id)
        store.rerate(batch_id, customers(), rates())

    rows = normalise(decode(messages, MEDIATED_CDR, value_col), with_month=True)
    writer = rows.writeStream.foreachBatch(save).outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
