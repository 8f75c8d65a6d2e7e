"""Change detection by row count against a stored cursor."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

CURSOR_SCHEMA = "source string, last_count bigint, run_key string, snapshot string"


def current_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source with its row count."""
    return reduce(DataFrame.unionByName, [
        table.agg(F.count("*").alias("current_count")).select(F.lit(name).alias("source"), "*")
        for name, table in tables.items()])


def new_rows_since(counts: DataFrame, cursors: DataFrame) -> DataFrame:
    """Which sources have grown beyond their cursor, and the cursor after that.

    A source without a cursor counts from 0. A table that shrinks never fires, and the
    cursor never falls. The run key names the count, so one count fires one run.
    """
    state = counts.join(cursors.select("source", "last_count"), "source", "left")
    last = F.coalesce("last_count", F.lit(0).cast("bigint"))
    fires = F.col("current_count") > last
    return state.select(
        "source", "last_count", "current_count", fires.alias("fires"),
        F.when(fires, F.col("current_count")).otherwise(F.col("last_count")).alias("new_cursor"),
        F.when(fires, F.concat_ws("_", "source", F.lit("ingest"),
                                  F.col("current_count").cast("string"))).alias("run_key"))


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    """The furthest committed cursor of each source, from the append-only cursor table."""
    log = spark.read.schema(CURSOR_SCHEMA).parquet(path)
    return log.groupBy("source").agg(
        F.max("last_count").alias("last_count"),
        F.max_by("run_key", "last_count").alias("run_key"),
        F.max_by("snapshot", "last_count").alias("snapshot"))


def create_cursors(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], CURSOR_SCHEMA).write.mode("append").parquet(path)


def commit_cursor(spark: SparkSession, path: str, source: str, count: int, run_key: str,
                  snapshot: str) -> None:
    """Advance a cursor. Call it after the snapshot is written, never before."""
    spark.createDataFrame([(source, count, run_key, snapshot)], CURSOR_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(path)
