"""Hourly price bars, over a table, or kept up by a stream in any number of batches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.messages import utc
from millrace.functions.missing import column, present
from millrace.sinks import batches
from millrace.sinks.slices import SLICE, attempt_path, new_attempt

START = "window_start"
BAR = ["n_rows", "first_value", "last_value", "low_value", "high_value"]


def _partial(df: DataFrame, time: str, key: str, value: str, order: Column, width: str) -> DataFrame:
    """Bars with the orders of their first and last value, so that bars can be merged."""
    at = column(time)
    if isinstance(df.schema[time].dataType, T.TimestampType):
        at = utc(at)
    v = present(df, value)
    # A missing value is a row of the bar, but neither its first nor its last value.
    placed = F.when(v.isNotNull(), order)
    bars = df.groupBy(F.window(at, width).alias("w"), column(key)).agg(
        F.count("*").alias("n_rows"), F.min_by(v, placed).alias("first_value"),
        F.max_by(v, placed).alias("last_value"), F.min(v).alias("low_value"),
        F.max(v).alias("high_value"), F.min(placed).alias("first_at"), F.max(placed).alias("last_at"))
    return bars.select(F.col("w.start").alias(START), column(key), *BAR, "first_at", "last_at")


def hourly_bars(df: DataFrame, time: str, key: str, value: str, order: Column,
                width: str = "1 hour") -> DataFrame:
    """Per key and time window: row count, first, last, least and greatest value.

    ``order`` decides which row is first and last. All of it is partial aggregation, so a
    key that holds most rows costs one row per task and window in the shuffle. One number,
    such as ``time_order``, aggregates by hash; a struct would be sorted. Windows are those
    of UTC. NULL and NaN values count as rows and in nothing else; NULL keys are a group,
    and rows without a time are in no window.
    """
    return _partial(df, time, key, value, order, width).drop("first_at", "last_at")


def bar_writer(path: str, time: str, key: str, value: str, order: Column,
               width: str = "1 hour") -> Callable[[DataFrame, int], None]:
    """Callback that aggregates a micro-batch and writes its bars; a replay replaces them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if stream_id is None:
            raise RuntimeError("the batch does not belong to a running stream")
        name, attempt, seen = f"{stream_id}.{batch_id}", new_attempt(), Observation()
        bars = _partial(batch, time, key, value, order, width).observe(seen, F.count("*").alias("rows"))
        bars.write.parquet(f"{attempt_path(path, attempt)}/{SLICE}={name}")
        n = seen.get["rows"]
        if n:
            batches.commit_batch(spark, path, batches.entries(spark, path), name, attempt, stream_id,
                                 (batch_id, batch_id), n, n, None, 0)
    return write


def start_bars(rows: DataFrame, path: str, checkpoint: str, time: str, key: str, value: str,
               order: Column, width: str = "1 hour", interval: str | None = None) -> StreamingQuery:
    """Bars of a stream, in the table at ``path``.

    Each micro-batch adds the bars of its own rows, and ``read_bars`` merges them. So the
    result does not depend on how a backlog is cut into batches or in what order its rows
    come, no row is dropped as late, and the stream keeps no state. ``compact_bars`` merges
    for good what many batches have left.
    """
    batches.create_log(rows.sparkSession, path)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (rows.writeStream.foreachBatch(bar_writer(path, time, key, value, order, width))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def bar_schema(spark: SparkSession, rows: T.StructType, time: str, key: str, value: str,
               order: Column) -> T.StructType:
    """What is stored of a stream of such rows."""
    return _partial(spark.createDataFrame([], rows), time, key, value, order, "1 hour").schema


def _merged(parts: DataFrame, key: str) -> DataFrame:
    return parts.groupBy(START, column(key)).agg(
        F.sum("n_rows").alias("n_rows"), F.min_by("first_value", "first_at").alias("first_value"),
        F.max_by("last_value", "last_at").alias("last_value"), F.min("low_value").alias("low_value"),
        F.max("high_value").alias("high_value"), F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"))


def read_bars(spark: SparkSession, path: str, key: str, stored: T.StructType) -> DataFrame:
    """The bars of all rows so far: one aggregation over the few rows that batches left."""
    parts = batches.read_entries(spark, path, stored, batches.shown(batches.entries(spark, path)))
    return _merged(parts, key).drop("first_at", "last_at")


def compact_bars(spark: SparkSession, path: str, key: str, stored: T.StructType, keep: int = 1,
                 least: int = 2) -> int:
    """Merge the bars of each stream's batches, but for the last ``keep``, into one slice; how
    many batches were merged. Bars stay open: a late row still finds its hour."""
    gathered = 0
    for stream_id, own in batches.gatherable(batches.entries(spark, path), keep, least):
        merged = _merged(batches.read_entries(spark, path, stored, own), key).select(*stored.names)
        batches.write_gathered(spark, path, merged, stream_id, own)
        gathered += len(own)
    return gathered


def closed_bars(bars: DataFrame, last_time: Column, late: timedelta,
                width: timedelta = timedelta(hours=1)) -> DataFrame:
    """The bars that end at least ``late`` before the last time seen, which a row may still
    change if it comes later than that."""
    return bars.where(F.col(START) + F.lit(width) <= last_time - F.lit(late))
