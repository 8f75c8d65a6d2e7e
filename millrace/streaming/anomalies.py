"""Rows of a stream scored against the history of their key, which is kept as moments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.missing import column, present
from millrace.sinks.files import create_empty, replace_slice

STREAM, BATCH = "stream_id", "batch_id"
Z, FLAG = "z_score", "is_anomaly"


def day_moments(df: DataFrame, time: str, key: str, value: str) -> DataFrame:
    """(key, day, n, mean, squares): values that are there, their mean, and the sum of the
    squares of their distances from it. Rows without a time or a value add nothing."""
    v = present(df, value)
    return (df.where(column(time).isNotNull() & v.isNotNull())
            .groupBy(column(key).alias("key"), F.to_date(column(time)).alias("day"))
            .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("squares")))


def history(days: DataFrame) -> DataFrame:
    """(key, day, mean, spread) of all values of the key on the days before.

    The windows run over one row for each key, day and batch. Sums are of distances from the
    mean of the key's first day, so that a large mean costs no precision.
    """
    own = Window.partitionBy("key")
    moved = days.withColumn("shift", F.min_by("mean", "day").over(own))
    off = F.col("mean") - F.col("shift")
    sums = moved.groupBy("key", "day", "shift").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * off).alias("a"),
        F.sum(F.col("squares") + F.col("n") * off * off).alias("b"))
    before = own.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    n, a, b = (F.sum(c).over(before) for c in ("n", "a", "b"))
    spread = F.when(n > 1, F.sqrt(F.greatest(b - a * a / n, F.lit(0.0)) / (n - 1)))
    return sums.select("key", "day", (F.col("shift") + a / n).alias("mean"), spread.alias("spread"))


def scored(df: DataFrame, known: DataFrame, time: str, key: str, value: str, limit: float) -> DataFrame:
    """The rows with z-score and flag. NULL keys are a key; a row without a time, a value or a
    history of two values that differ has no score and is no anomaly."""
    stats = known.select(F.col("key").alias("__key"), F.col("day").alias("__day"),
                         F.col("mean").alias("__mean"), F.col("spread").alias("__spread"))
    same = column(key).eqNullSafe(F.col("__key")) & (F.to_date(column(time)) == F.col("__day"))
    z = (present(df, value) - F.col("__mean")) / F.nullif(F.col("__spread"), F.lit(0.0))
    return (df.join(stats, same, "left").withColumn(Z, z)
            .withColumn(FLAG, F.coalesce(F.abs(F.col(Z)) > limit, F.lit(False)))
            .select(*[column(c) for c in df.columns], Z, FLAG))


def _sliced(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType())])


def anomaly_writer(path: str, time: str, key: str, value: str,
                   limit: float = 3.0) -> Callable[[DataFrame, int], None]:
    """Callback that adds a micro-batch's moments to those kept, and scores its rows by them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if stream_id is None:
            raise RuntimeError("the batch does not belong to a running stream")
        name = {STREAM: stream_id, BATCH: batch_id}
        moments = day_moments(batch, time, key, value)
        replace_slice(moments, f"{path}/moments", name)
        # A replay sees what the batch saw at first: the slices up to its own.
        kept = spark.read.schema(_sliced(moments.schema)).parquet(f"{path}/moments").where(
            (F.col(STREAM) == stream_id) & (F.col(BATCH) <= batch_id)).drop(STREAM, BATCH)
        replace_slice(scored(batch, history(kept), time, key, value, limit), f"{path}/scored", name)
    return write


def start_anomalies(rows: DataFrame, path: str, checkpoint: str, time: str, key: str, value: str,
                    limit: float = 3.0, interval: str | None = None) -> StreamingQuery:
    """Score the rows of a stream as they come; ``read_scored`` has them.

    A row is scored against all values of its key on earlier days that came with its batch
    or before. So the scores are the same however the stream is cut into batches, if no row
    of an earlier day comes in a later batch. What was scored is never read again: of each
    batch a row of moments for each key and day stays.
    """
    spark = rows.sparkSession
    nothing = spark.createDataFrame([], rows.schema)
    moments = day_moments(nothing, time, key, value)
    for frame, name in ((moments, "moments"), (scored(nothing, history(moments), time, key, value, limit), "scored")):
        create_empty(spark, f"{path}/{name}", _sliced(frame.schema), [STREAM, BATCH])
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (rows.writeStream.foreachBatch(anomaly_writer(path, time, key, value, limit))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def read_scored(spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
    """The rows of the stream, whose schema was ``rows``, with score and flag."""
    known = T.StructType([*rows.fields, T.StructField(Z, T.DoubleType()), T.StructField(FLAG, T.BooleanType())])
    return spark.read.schema(_sliced(known)).parquet(f"{path}/scored").drop(STREAM, BATCH)
