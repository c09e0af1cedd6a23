"""Kafka message source (needs the spark-sql-kafka connector on the classpath).

Connection settings come from the caller (options or environment), never
from code.  The frame has the connector's columns: key, value (binary),
topic, partition, offset, timestamp, timestampType.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Messages of a micro-batch, unless the caller says otherwise.
MAX_OFFSETS_PER_TRIGGER = 5_000_000


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    extra: dict[str, str] | None = None,
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options.  ``max_offsets_per_trigger`` bounds each micro-batch
    (the sinks persist a batch while writing it; what is left waits for the
    next batch); ``min_partitions`` splits
    topic partitions into more Spark tasks when the topic has fewer
    partitions than the cluster has cores."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
    }
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Streaming frame over one topic (``value`` is the message body)."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kwargs)).load()
