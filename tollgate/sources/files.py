"""File sources: stored tables, JSON snapshots and file-backed message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tollgate.schemas import RAW_CDR
from tollgate.versions import MonthTable


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A stored parquet table; with ``schema``, columns come back in that
    order (partition columns included) so the frame matches the contract.  Of a
    table with versions, the newest."""
    table = MonthTable(spark, path)
    df = table.read() if table.exists() else spark.read.parquet(path)
    if schema is not None:
        df = df.select(*[f.name for f in schema.fields])
    return df


def read_snapshot(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_CDR,
    multiline: bool = True,
) -> DataFrame:
    """Raw records dumped as JSON for a backfill.

    ``multiline=True`` reads files that hold one JSON array of records (each
    file is then read by one task; :func:`tollgate.sources.json_array.read_json_array`
    splits a huge one); ``False`` reads JSON lines, which split into many tasks per
    file.  The schema is declared, never inferred.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


#: Files of a micro-batch, unless the caller says otherwise: the sinks hold a
#: batch in cache, so a backlog is worked off in bounded batches.
MAX_FILES_PER_TRIGGER = 200


def message_files(
    spark: SparkSession, path: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Streaming stand-in for a topic: one message per text line, exposed as
    the ``value`` column a Kafka source would give.  Files beyond the bound wait
    for the next batch."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path)

