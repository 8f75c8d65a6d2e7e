"""Message stream into a table with generated keys and insert times, and its compaction."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.contracts import EVENT_TIME, MESSAGE_KEY, PRICE_ROW
from millrace.operators.parsing import RAW, REASON
from millrace.sinks import batches
from millrace.sinks.slices import SLICE, attempt_path, new_attempt
from millrace.streaming.ingest import INTERVAL, BatchReport, start_stream

log = logging.getLogger(__name__)

ID, INSERTED = "id", "inserted_at"
TASK, PLACE = "task", "place"
BROADCAST_IDS = 1 << 20  # of eight bytes
PLACE_BITS = 33  # of monotonically_increasing_id; the rest is the task

# What is stored. Rows of a micro-batch have no id yet, but their task and their place in it.
STORED = T.StructType([
    T.StructField(ID, T.LongType()), *PRICE_ROW.fields, T.StructField(RAW, T.StringType()),
    T.StructField(REASON, T.StringType()), T.StructField(INSERTED, T.TimestampNTZType()),
    T.StructField(TASK, T.IntegerType()), T.StructField(PLACE, T.LongType())])


def create_managed(spark: SparkSession, path: str) -> None:
    """Make sure that the table can be read before its first row arrives."""
    batches.create_log(spark, path)


def managed_writer(path: str, on_batch: Callable[[BatchReport], None] | None = None
                   ) -> Callable[[DataFrame, int], None]:
    """Callback that adds a micro-batch of sorted messages to the table.

    The rows are written once, by one job, into a folder that nobody sees; a row of the log
    then shows it. A replay writes another folder, whose entry takes the place of the former
    one. Keys ascend from batch to batch and are given away once only: a row's key is the
    first one of its task, which is known when the tasks are counted, and its place there.
    Rejects and replays leave gaps, as in a database. One stream writes at a time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if stream_id is None:
            raise RuntimeError("the batch does not belong to a running stream")
        name, attempt = f"{stream_id}.{batch_id}", new_attempt()
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        at = F.monotonically_increasing_id()
        rows = batch.withColumns({
            ID: F.lit(None).cast("bigint"), INSERTED: F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"),
            TASK: F.shiftright(at, PLACE_BITS).cast("int"),
            PLACE: at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).select(*STORED.names)
        folder = f"{attempt_path(path, attempt)}/{SLICE}={name}"
        rows.write.parquet(folder)
        tasks = spark.read.schema(STORED).parquet(folder).groupBy(TASK).agg(
            F.max(PLACE).alias("last"), F.count("*").alias("n"),
            F.count_if(F.col(REASON).isNull()).alias("accepted")).collect()
        known = batches.entries(spark, path)
        next_id = max((e["next_id"] for e in known), default=0)
        sizes = {row[TASK]: row["last"] + 1 for row in tasks}
        first_ids = []
        for task in range(max(sizes, default=-1) + 1):
            first_ids.append(next_id)
            next_id += sizes.get(task, 0)
        report = BatchReport(batch_id, sum(r["n"] for r in tasks), sum(r["accepted"] for r in tasks),
                             sum(r["n"] - r["accepted"] for r in tasks))
        if tasks:
            batches.commit_batch(spark, path, known, name, attempt, stream_id, (batch_id, batch_id), report.rows_in,
                                 report.rows_accepted, first_ids, next_id)
        log.info("%s", report)
        if on_batch:
            on_batch(report)
    return write


def start_managed(messages: DataFrame, path: str, checkpoint: str, *, value: str = "value",
                  interval: str | None = INTERVAL,
                  on_batch: Callable[[BatchReport], None] | None = None) -> StreamingQuery:
    """Parse a message stream into the managed table at ``path``, created if absent."""
    create_managed(messages.sparkSession, path)
    return start_stream(messages, managed_writer(path, on_batch), checkpoint, value, interval)


def _with_ids(spark: SparkSession, path: str, entries: list[Row]) -> DataFrame:
    rows = batches.read_entries(spark, path, STORED, entries)
    firsts = spark.createDataFrame([(e[SLICE], e["first_ids"]) for e in entries if e["first_ids"] is not None],
                                   "slice string, first_ids array<bigint>")
    # One number for each task of each batch since the last compaction.
    if sum(len(e["first_ids"] or ()) for e in entries) <= BROADCAST_IDS:
        firsts = F.broadcast(firsts)
    found = rows.join(firsts, SLICE, "left")
    made = F.coalesce(ID, F.get("first_ids", F.col(TASK)) + F.col(PLACE))
    return found.withColumn(ID, made).select(*[n for n in STORED.names if n not in (TASK, PLACE)])


def _seen(spark: SparkSession, path: str, upto: int | None = None) -> list[Row]:
    return batches.shown(batches.entries(spark, path, upto))


def read_managed(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The accepted rows: id, the columns of a price, inserted_at; or those that there were
    when the log ended at ``upto``, whatever was written or compacted since."""
    return _with_ids(spark, path, _seen(spark, path, upto)).where(F.col(REASON).isNull()).select(
        ID, *PRICE_ROW.names, INSERTED)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _with_ids(spark, path, _seen(spark, path)).where(F.col(REASON).isNotNull()).select(
        MESSAGE_KEY, RAW, REASON, INSERTED)


def batch_spans(rows: DataFrame) -> DataFrame:
    """Of rows of the table, one row per micro-batch: how many there are, and their first and last
    key and time. A batch has one insert time, which a compaction leaves as it is."""
    return rows.groupBy(INSERTED).agg(
        F.count("*").alias("n"), F.min(ID).alias("first_id"), F.max(ID).alias("last_id"),
        F.min(EVENT_TIME).alias("first_time"), F.max(EVENT_TIME).alias("last_time"))


def snapshot_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """(number of the log's last entry, accepted rows), without reading a row."""
    seen = _seen(spark, path)
    return max((e["number"] for e in seen), default=-1), sum(e["rows_accepted"] for e in seen)


def managed_batches(spark: SparkSession, path: str) -> DataFrame:
    """What the log shows: one row per micro-batch or range of compacted ones, with its rows."""
    names = ["stream_id", "first_batch", "last_batch", "rows_in", "rows_accepted"]
    return spark.createDataFrame([tuple(e[n] for n in names) for e in _seen(spark, path)],
                                 "stream_id string, first_batch bigint, last_batch bigint, rows_in bigint, "
                                 "rows_accepted bigint")


def compact(spark: SparkSession, path: str, keep: int = 1, least: int = 2) -> int:
    """Gather the small slices of each stream into large ones; how many were gathered.

    The last ``keep`` batches of a stream stay as they are, as the last one may be replayed;
    streams with fewer than ``least`` others are left alone. What was compacted before is not
    touched again. Rows are written with their ids, in files of some size, and one entry of
    the log puts them in the place of the slices, so a reader sees the one or the others, and
    an interrupted compaction changes nothing. From then on no reader lists the slices.
    """
    gathered = 0
    for stream_id, own in batches.gatherable(batches.entries(spark, path), keep, least):
        rows = _with_ids(spark, path, own).withColumns({
            TASK: F.lit(None).cast("int"), PLACE: F.lit(None).cast("bigint")}).select(*STORED.names)
        batches.write_gathered(spark, path, rows, stream_id, own)
        gathered += len(own)
    return gathered
