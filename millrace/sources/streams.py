"""Streaming sources that all deliver one message per row in a ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamReader


def kafka_source_options(servers: str, topic: str, *, starting_offsets: str = "earliest",
                         fail_on_data_loss: bool = False, max_offsets: int | None = None,
                         min_partitions: int | None = None,
                         extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the Kafka source.

    ``max_offsets`` bounds a micro-batch after an outage. ``min_partitions`` cuts the
    offset range of a busy topic partition into several tasks; messages are keyed, so
    a frequent key would otherwise be one long task.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options | dict(extra or {})


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def _file_stream(spark: SparkSession, form: str, max_files: int | None,
                 max_bytes: int | None) -> DataStreamReader:
    """``max_files`` or ``max_bytes`` bound a micro-batch when there is a backlog."""
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    options = {name: str(limit) for name, limit in limits.items() if limit is not None}
    return spark.readStream.format(form).options(**options)


def json_lines_stream(spark: SparkSession, path: str, max_files: int | None = None,
                      max_bytes: int | None = None) -> DataFrame:
    """Text files of one JSON message per line, as the Kafka source would deliver them."""
    return _file_stream(spark, "text", max_files, max_bytes).load(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Files of a Parquet table as they arrive. The path may be a folder or a glob."""
    return _file_stream(spark, "parquet", max_files, max_bytes).schema(schema).load(path)
