"""Message stream to table, one job per micro-batch and no duplicates on replay."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.contracts import MESSAGE_KEY, PRICE_ROW
from millrace.operators.parsing import RAW, REASON, accepted, sort_messages
from millrace.sinks import jdbc
from millrace.sinks.files import create_empty, replace_slice

log = logging.getLogger(__name__)

KIND, STREAM, BATCH = "kind", "stream_id", "batch_id"
ACCEPTED, REJECTED = "accepted", "rejected"
INTERVAL = "10 seconds"

SINK_SCHEMA = T.StructType([
    *PRICE_ROW.fields,
    T.StructField(RAW, T.StringType()),
    T.StructField(REASON, T.StringType()),
    T.StructField(KIND, T.StringType()),
    T.StructField(STREAM, T.StringType()),
    T.StructField(BATCH, T.LongType()),
])


@dataclass(frozen=True)
class BatchReport:
    batch_id: int
    rows_in: int
    rows_accepted: int
    rows_rejected: int


def batch_writer(path: str, on_batch: Callable[[BatchReport], None] | None = None,
                 rebalance: bool = False) -> Callable[[DataFrame, int], None]:
    """Callback that writes a micro-batch of sorted messages.

    Accepted and rejected rows go out in the same job, so the batch is read and parsed
    once and becomes visible as a whole. Its slice is named by the stream's own
    identity, which lives in the checkpoint, and the batch number: a replay replaces
    the slice, while a stream restarted without its checkpoint cannot overwrite rows of
    its predecessor. A batch without rows writes nothing.

    ``rebalance`` merges the output of many small tasks into few files, for one shuffle
    of the batch; leave it off for a large backlog.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if stream_id is None:
            raise RuntimeError("the batch does not belong to a running stream")
        rows = batch.withColumn(KIND, F.when(F.col(REASON).isNull(), ACCEPTED).otherwise(REJECTED))
        if rebalance:
            rows = rows.hint("rebalance")
        # Observed in the writing stage itself, so that a recomputed shuffle cannot count twice.
        seen = Observation()
        rows = rows.observe(seen, F.count("*").alias("rows_in"),
                            F.count_if(F.col(KIND) == ACCEPTED).alias("rows_accepted"))
        replace_slice(rows, path, {STREAM: stream_id, BATCH: batch_id})
        counts = seen.get
        report = BatchReport(batch_id, counts["rows_in"], counts["rows_accepted"],
                             counts["rows_in"] - counts["rows_accepted"])
        log.info("%s", report)
        if on_batch:
            on_batch(report)
    return write


def database_writer(options: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """Callback that appends the accepted rows to a database table instead.

    Databases commit per task here, so delivery is at least once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        jdbc.append_batches(accepted(batch), options)
    return write


def start_stream(messages: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str,
                 value: str = "value", interval: str | None = INTERVAL) -> StreamingQuery:
    """Parse a message stream and hand each micro-batch of sorted messages to ``writer``.

    ``interval=None`` works off what is there and stops. The checkpoint must lie on
    storage that outlives the machine.
    """
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (sort_messages(messages, value).writeStream.foreachBatch(writer)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_ingest(messages: DataFrame, path: str, checkpoint: str, *, value: str = "value",
                 interval: str | None = INTERVAL, rebalance: bool = False,
                 on_batch: Callable[[BatchReport], None] | None = None) -> StreamingQuery:
    """Parse a message stream into the table at ``path``, created if absent."""
    create_empty(messages.sparkSession, path, SINK_SCHEMA, [STREAM, BATCH])
    return start_stream(messages, batch_writer(path, on_batch, rebalance), checkpoint, value,
                        interval)


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SINK_SCHEMA).parquet(path)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """Accepted rows. The kind is a column: a replay replaces both kinds of its batch, and
    no row has to be sorted by kind before it is written."""
    return read_sink(spark, path).where(F.col(KIND) == ACCEPTED).select(*PRICE_ROW.names)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return read_sink(spark, path).where(F.col(KIND) == REJECTED).select(MESSAGE_KEY, RAW, REASON)


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: rows in, accepted and rejected, from the file footers."""
    kept = F.col(KIND) == ACCEPTED
    return (read_sink(spark, path).groupBy(STREAM, BATCH)
            .agg(F.count("*").alias("rows_in"), F.count_if(kept).alias("rows_accepted"),
                 F.count_if(~kept).alias("rows_rejected")))
