"""A log of micro-batches, which shows their folders, and compactions in place of many."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from millrace.sinks.slices import ATTEMPT, SLICE, attempt_path, new_attempt

# One row for each micro-batch, and one for each compaction, which covers a range of them.
LOG = ("slice string, attempt string, number bigint, stream_id string, first_batch bigint, last_batch bigint, "
       "rows_in bigint, rows_accepted bigint, first_ids array<bigint>, next_id bigint")


def create_log(spark: SparkSession, path: str) -> None:
    """Make sure that the table can be read before its first row arrives."""
    spark.createDataFrame([], LOG).write.mode("append").parquet(f"{path}/log")


def entries(spark: SparkSession, path: str, upto: int | None = None) -> list[Row]:
    """All rows of the log, or those up to a number, in order."""
    log = spark.read.schema(LOG).parquet(f"{path}/log")
    found = (log if upto is None else log.where(F.col("number") <= upto)).collect()
    return sorted(found, key=lambda entry: entry["number"])


def shown(log: Sequence[Row]) -> list[Row]:
    """The entries that readers see: of those for the same batches the last one, and one for
    more of them in place of those for less. There are as many as compactions, and as batches
    since the last one."""
    seen: dict[str, list[Row]] = {}
    for entry in log:
        own = seen.setdefault(entry["stream_id"], [])
        own[:] = [e for e in own if not entry["first_batch"] <= e["first_batch"] <= entry["last_batch"]]
        own.append(entry)
    return sorted((e for own in seen.values() for e in own), key=lambda e: e["number"])


def folder_of(path: str, entry: Row) -> str:
    return f"{attempt_path(path, entry[ATTEMPT])}/{SLICE}={entry[SLICE]}"


def read_entries(spark: SparkSession, path: str, stored: T.StructType, log: Sequence[Row]) -> DataFrame:
    """The rows of these entries, with their slice; no other folder is listed."""
    full = T.StructType([*stored.fields, T.StructField(ATTEMPT, T.StringType()), T.StructField(SLICE, T.StringType())])
    if not log:
        return spark.createDataFrame([], full).drop(ATTEMPT)
    folders = [folder_of(path, entry) for entry in log]
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders).drop(ATTEMPT)


def commit_batch(spark: SparkSession, path: str, log: Sequence[Row], name: str, attempt: str, stream_id: str,
                 batches: tuple[int, int], rows_in: int, rows_accepted: int, first_ids: list[int] | None,
                 next_id: int) -> None:
    """Show the folder of an attempt, from now on; one writer at a time."""
    number = 1 + max((e["number"] for e in log), default=-1)
    entry = (name, attempt, number, stream_id, *batches, rows_in, rows_accepted, first_ids, next_id)
    spark.createDataFrame([entry], LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")


def gatherable(log: Sequence[Row], keep: int, least: int) -> Iterator[tuple[str, list[Row]]]:
    """Per stream the entries of single batches that a compaction may gather: all but the last
    ``keep``, as the last one may be replayed, if they are at least ``least``."""
    seen = shown(log)
    for stream_id in sorted({e["stream_id"] for e in seen}):
        own = sorted((e for e in seen if e["stream_id"] == stream_id and e["first_batch"] == e["last_batch"]),
                     key=lambda e: e["first_batch"])
        own = own[:max(0, len(own) - keep)]
        if len(own) >= max(2, least):
            yield stream_id, own


def write_gathered(spark: SparkSession, path: str, rows: DataFrame, stream_id: str, own: Sequence[Row]) -> None:
    """Write what a range of batches holds into files of some size, and show it in their place."""
    low, high, attempt = own[0]["first_batch"], own[-1]["last_batch"], new_attempt()
    name = f"{stream_id}.{low}-{high}"
    rows.hint("rebalance").write.parquet(f"{attempt_path(path, attempt)}/{SLICE}={name}")
    log = entries(spark, path)
    commit_batch(spark, path, log, name, attempt, stream_id, (low, high), sum(e["rows_in"] for e in own),
                 sum(e["rows_accepted"] for e in own), None, max(e["next_id"] for e in log))
