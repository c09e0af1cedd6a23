"""Kafka sink for key/value message frames (needs the Kafka connector)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def kafka_sink_options(servers: str, topic: str, checkpoint: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    opts.update(extra or {})
    return opts


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str, **extra: str) -> DataStreamWriter:
    """A not-yet-started writer for a streaming key/value frame (see
    :func:`tollgate.operators.mediation.encode`)."""
    return messages.writeStream.format("kafka").options(**kafka_sink_options(servers, topic, checkpoint, extra))


def write_kafka_batch(messages: DataFrame, servers: str, topic: str, **extra: str) -> None:
    """Batch write of a key/value frame (inside ``foreachBatch``)."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    opts.update(extra)
    messages.write.format("kafka").options(**opts).save()
