"""Parquet sinks whose repetition leaves no duplicates."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.session import work_dir

RUN = "run_id"
RUN_NAME = re.compile(r"[A-Za-z0-9._-]+")


def replace_slice(df: DataFrame, path: str, slice_of: Mapping[str, object]) -> None:
    """Write the rows as one slice of a partitioned table, in place of that slice.

    ``slice_of`` names the slice, such as a run or a micro-batch; writing it again
    replaces it and leaves all others alone. The write is one job, committed as a whole.
    """
    named = df.withColumns({name: F.lit(value) for name, value in slice_of.items()})
    (named.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*slice_of)
     .parquet(path))


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Append a whole table as one run: all rows or none, and once however often it is retried."""
    if not RUN_NAME.fullmatch(run_id):
        raise ValueError(f"a run name has letters, digits, '.', '_' and '-' only: {run_id!r}")
    seen = Observation()
    replace_slice(df.observe(seen, F.count("*").alias("rows")), path, {RUN: run_id})
    if seen.get["rows"] == 0:
        # Without rows there is no slice to replace; leave one that is empty.
        df.limit(0).write.mode("overwrite").parquet(f"{path}/{RUN}={run_id}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a table. Run names stay text, also where they look like a number or date."""
    found = spark.read.parquet(path).schema
    typed = T.StructType([T.StructField(f.name, T.StringType()) if f.name == RUN else f
                          for f in found])
    return spark.read.schema(typed).parquet(path)


def record_metrics(spark: SparkSession, path: str, run_id: str, step: str,
                   metrics: Mapping[str, float | str | DataFrame]) -> None:
    """What a step of a run has to report, beside the data: one row per figure or text.

    A list, such as the distinct values of a column or the first rows of a table, is a frame
    of one text column and becomes a row for each of its texts, without passing through the
    driver. Recording a step again, as a retry does, replaces what it reported.
    """
    single = [(name, None, value) if isinstance(value, str) else (name, float(value), None)
              for name, value in metrics.items() if not isinstance(value, DataFrame)]
    rows = spark.createDataFrame(single, "metric string, value double, text string").coalesce(1)
    for name, texts in metrics.items():
        if isinstance(texts, DataFrame):
            rows = rows.union(texts.select(F.lit(name), F.lit(None).cast("double"),
                                           F.col(texts.columns[0]).cast("string")))
    replace_slice(rows, path, {RUN: run_id, "step": step})


def write_snapshot(df: DataFrame, path: str) -> None:
    """A full copy of the table under its own path.

    Every snapshot gets a new path and becomes current only when its cursor is
    committed, so that readers of the former one are not disturbed.
    """
    df.write.mode("overwrite").parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back.

    What follows does not compute it again, survives lost executors, and is planned with
    its real size: Spark broadcasts it in a join if it turned out small, and only then.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_empty(spark: SparkSession, path: str, schema: T.StructType,
                 partitions: Sequence[str] = ()) -> None:
    """Make sure that the table can be read before its first row arrives."""
    (spark.createDataFrame([], schema).write.mode("append")
     .partitionBy(*partitions).parquet(path))
