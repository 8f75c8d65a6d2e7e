"""Tables of named slices that become visible, and are replaced, by one commit."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.functions.missing import column, is_missing
from millrace.operators.quality import require_counts
from millrace.sinks.files import RUN_NAME

SLICE, ATTEMPT = "slice", "attempt"
COMMIT_SCHEMA = "slice string, attempt string, rows bigint, number bigint"

# Each write has a folder of its own, {path}/data/attempt=.../slice=.../, which no reader looks
# into until a row of {path}/commits names it. A commit is one file. What is replaced or was
# never committed stays on disk until it is cleaned, and is never listed.


def new_attempt() -> str:
    return uuid.uuid4().hex


def attempt_path(path: str, attempt: str) -> str:
    return f"{path}/data/{ATTEMPT}={attempt}"


def create_slices(spark: SparkSession, path: str) -> None:
    """Make sure that the table can be read before its first commit."""
    spark.createDataFrame([], COMMIT_SCHEMA).write.mode("append").parquet(f"{path}/commits")


def commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/commits")


def commit(spark: SparkSession, path: str, attempt: str, rows: Mapping[str, int]) -> None:
    """Show the slices of an attempt, in place of what they were; all of them at once.

    One writer at a time: the number of a commit is the one after the last.
    """
    last = commits(spark, path).agg(F.max("number")).first()[0]
    number = 0 if last is None else last + 1
    spark.createDataFrame([(name, attempt, n, number) for name, n in rows.items()], COMMIT_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(f"{path}/commits")


def visible(spark: SparkSession, path: str) -> DataFrame:
    """(slice, attempt, rows) of the last commit of each slice."""
    return commits(spark, path).groupBy(SLICE).agg(
        F.max_by(ATTEMPT, "number").alias(ATTEMPT), F.max_by("rows", "number").alias("rows"))


def read_slices(spark: SparkSession, path: str, schema: T.StructType,
                names: Iterable[str] | None = None) -> DataFrame:
    """The rows of the visible slices, or of the named ones among them, with their slice.

    Only their folders are listed. There are as many as slices, runs for instance.
    """
    shown = visible(spark, path).where("rows > 0")
    if names is not None:
        shown = shown.where(F.col(SLICE).isin(list(names)))
    folders = [f"{attempt_path(path, row[ATTEMPT])}/{SLICE}={row[SLICE]}" for row in shown.collect()]
    full = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType()),
                         T.StructField(SLICE, T.StringType())])
    if not folders:
        return spark.createDataFrame([], full).drop(ATTEMPT)
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders).drop(ATTEMPT)


def publish_observed(df: DataFrame, path: str, run_id: str, names: Iterable[str],
                     fail_on_empty: bool = False) -> dict:
    """Write a table, audit what was written, and show it as a run only if the audit passes.

    Missing values of the required columns are counted by the very tasks that write, so the
    input is read once, and once only: the check cannot have seen other rows than those
    written. The report is that of the null check. A failed one raises, and the rows stay
    hidden, as do those of a run that died before its commit. A retry writes an attempt of
    its own and replaces the run when it is committed.
    """
    if not RUN_NAME.fullmatch(run_id):
        raise ValueError(f"a run name has letters, digits, '.', '_' and '-' only: {run_id!r}")
    spark, names, attempt, seen = df.sparkSession, list(names), new_attempt(), Observation()
    nulls = [F.count_if(test).alias(f"nulls{i}") for i, test in enumerate(is_missing(df, names))]
    (df.observe(seen, F.count("*").alias("rows"), *nulls)
     .write.parquet(f"{attempt_path(path, attempt)}/{SLICE}={run_id}"))
    counts = seen.get
    report = require_counts(counts["rows"], {name: counts[f"nulls{i}"] for i, name in enumerate(names)},
                            fail_on_empty)
    commit(spark, path, attempt, {run_id: counts["rows"]})
    return report


def write_partitioned(df: DataFrame, path: str, attempt: str, by: str) -> dict[str, int]:
    """Write the rows of many slices as one attempt, in one job; the rows of each, counted in
    the footers of the files."""
    named = [c for c in df.columns if c != by]
    # Gathered by slice, so that a task does not open a file in each; large ones are split.
    out = df.select(*[column(c) for c in named], column(by).cast("string").alias(SLICE)).hint("rebalance", SLICE)
    out.write.partitionBy(SLICE).parquet(attempt_path(path, attempt))
    written = df.sparkSession.read.schema(out.schema).parquet(attempt_path(path, attempt))
    return {row[SLICE]: row["n"] for row in written.groupBy(SLICE).agg(F.count("*").alias("n")).collect()}
