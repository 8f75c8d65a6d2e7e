"""Kafka sinks for frames with ``key`` and ``value`` columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

# The delivery settings of the producer.
PRODUCER = {
    "acks": "all",
    "enable.idempotence": "true",
    "retries": "5",
    "retry.backoff.ms": "500",
    "linger.ms": "100",
    "compression.type": "snappy",
}


def kafka_sink_options(servers: str, topic: str,
                       producer: Mapping[str, str] | None = None) -> dict[str, str]:
    """Sink options. Delivery is at least once: a retried task sends its rows again."""
    settings = {**PRODUCER, **(producer or {})}
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            **{f"kafka.{name}": value for name, value in settings.items()}}


def publish(messages: DataFrame, options: Mapping[str, str]) -> None:
    messages.select("key", "value").write.format("kafka").options(**options).save()


def publish_stream(messages: DataFrame, options: Mapping[str, str],
                   checkpoint: str) -> DataStreamWriter:
    return (messages.select("key", "value").writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint))
