import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from frames import rows
from millrace.operators import audit, parsing
from millrace.sources.streams import (json_lines_stream, kafka_source_options, parquet_stream)
from millrace.streaming import ingest, rollup
from millrace.streaming.append import start_append

GOOD = '{"coin":"%s","usd":1,"eur":2,"timestamp":"2026-01-01T00:00:00+00:00"}'
AT = dt.datetime(2026, 1, 1)


class Stream:
    """A folder of message files, the sink and the checkpoint of one stream."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.inbox, self.sink = f"{folder}/in", f"{folder}/out"
        os.makedirs(self.inbox)
        self.reports = []

    def send(self, name, *lines):
        with open(f"{self.inbox}/{name}", "w") as file:
            file.write("\n".join(lines) + "\n")

    def run(self, checkpoint="c", **options):
        source = json_lines_stream(self.spark, self.inbox, options.pop("max_files", None))
        query = ingest.start_ingest(source, self.sink, f"{self.folder}/{checkpoint}",
                                    interval=None, on_batch=self.reports.append, **options)
        query.awaitTermination()

    def accepted(self):
        return rows(ingest.read_accepted(self.spark, self.sink).select("coin"))


@pytest.fixture
def stream(spark, folder):
    return Stream(spark, folder)


def test_accepted_and_rejected_rows(stream, spark):
    stream.send("1", GOOD % "a", "broken", '{"usd":1}', '{"coin":"b"}')
    stream.run()
    assert rows(ingest.read_accepted(spark, stream.sink)) == [("a", 1.0, 2.0, AT)]
    assert rows(ingest.read_rejected(spark, stream.sink)) == [
        ("b", '{"coin":"b"}', "bad_timestamp"), (None, "broken", "malformed"),
        (None, '{"usd":1}', "missing_key")]
    assert stream.reports == [ingest.BatchReport(0, 4, 1, 3)]
    assert rows(ingest.batch_counts(spark, stream.sink).drop("stream_id")) == [(0, 4, 1, 3)]


def test_restart_reads_only_new_files(stream):
    stream.send("1", GOOD % "a")
    stream.run()
    stream.run()
    stream.send("2", GOOD % "b")
    stream.run()
    assert stream.accepted() == [("a",), ("b",)]
    assert [report.rows_in for report in stream.reports] == [1, 1]


def test_replay_of_a_batch_leaves_no_duplicates(stream, spark):
    """The process dies after the write and before the batch is marked as done."""
    stream.send("1", GOOD % "a", "broken")
    stream.run()
    commits = f"{stream.folder}/c/commits"
    for name in os.listdir(commits):
        os.remove(f"{commits}/{name}")
    stream.run()
    assert len(stream.reports) == 2
    assert stream.accepted() == [("a",)]
    assert ingest.read_rejected(spark, stream.sink).count() == 1


def test_a_lost_checkpoint_overwrites_nothing(stream):
    stream.send("1", GOOD % "a")
    stream.run("first")
    os.remove(f"{stream.inbox}/1")
    stream.send("2", GOOD % "b")
    stream.run("second")  # batch 0 again, of another stream
    assert stream.accepted() == [("a",), ("b",)]


def test_several_batches_and_rebalanced_output(stream, spark):
    for i in range(3):
        stream.send(str(i), *[GOOD % f"c{i}"] * 10)
    stream.run(max_files=1, rebalance=True)
    assert ingest.read_accepted(spark, stream.sink).count() == 30
    assert sorted(report.rows_in for report in stream.reports) == [10, 10, 10]
    assert ingest.batch_counts(spark, stream.sink).count() == 3


def test_append_copies_only_what_is_new(spark, folder):
    def poll():
        source = parquet_stream(spark, f"{folder}/in", spark.range(1).schema)
        query = start_append(source, f"{folder}/out", f"{folder}/c")
        query.awaitTermination()
        return sum(progress["numInputRows"] for progress in query.recentProgress)

    spark.range(0, 100, 1, 2).write.parquet(f"{folder}/in")
    assert poll() == 100 and poll() == 0
    spark.range(100, 130).write.mode("append").parquet(f"{folder}/in")
    assert poll() == 30
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(spark.range(130))


def test_bytes_bound_a_batch(spark, folder):
    spark.range(0, 4000, 1, 4).write.parquet(f"{folder}/in")
    source = parquet_stream(spark, f"{folder}/in*", spark.range(1).schema, max_bytes=1)
    sizes = []
    (source.writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
     .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
     .awaitTermination())
    assert sizes == [1000] * 4


def test_a_stream_without_messages_leaves_a_readable_table(stream, spark):
    stream.run()
    assert stream.accepted() == [] and stream.reports == []


def test_an_empty_batch_writes_nothing(spark, folder):
    empty = spark.createDataFrame([], ingest.SINK_SCHEMA).drop("kind", "stream_id", "batch_id")
    with pytest.raises(RuntimeError, match="running stream"):
        ingest.batch_writer(f"{folder}/out")(empty, 0)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "s")
    try:
        ingest.batch_writer(f"{folder}/out")(empty, 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert not [name for name in os.listdir(f"{folder}/out") if name.startswith("stream_id")]


def test_a_validated_stream_is_enriched(stream, spark):
    stream.send("1", GOOD % "a", "broken", GOOD % "zz")
    names = spark.createDataFrame([("a", "Alpha")], "coin string, name string")
    valid = parsing.accepted(parsing.sort_messages(json_lines_stream(spark, stream.inbox)))
    query = start_append(audit.enrich(valid, names, "coin", "left").select("coin", "name"),
                         stream.sink, f"{stream.folder}/c")
    query.awaitTermination()
    assert rows(spark.read.parquet(stream.sink)) == [("a", "Alpha"), ("zz", None)]


def test_database_writer_takes_accepted_rows(spark, monkeypatch):
    written = []
    monkeypatch.setattr(ingest.jdbc, "append_batches",
                        lambda df, options: written.append((rows(df), options)))
    batch = spark.createDataFrame([("a", 1.0, 2.0, AT, None, None),
                                   (None, None, None, None, "x", "malformed")],
                                  ingest.SINK_SCHEMA[:6])
    ingest.database_writer({"url": "u"})(batch, 0)
    assert written == [([("a", 1.0, 2.0, AT)], {"url": "u"})]


def test_kafka_options():
    assert kafka_source_options("k:9092", "prices") == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "prices",
        "startingOffsets": "earliest", "failOnDataLoss": "false"}
    more = kafka_source_options("k", "t", max_offsets=10, min_partitions=4, extra={"x": "y"})
    assert (more["maxOffsetsPerTrigger"], more["minPartitions"], more["x"]) == ("10", "4", "y")


@pytest.mark.parametrize("files, compacted", [(1, False), (4, False), (16, False), (4, True)])
def test_streamed_bars_do_not_depend_on_batches(spark, folder, files, compacted):
    """Rows in no order of time, some very late, some without a value or a key."""
    data = [(dt.datetime(2026, 1, 1, (i * 7) % 24, i % 60), i, "ab"[i % 2] if i % 11 else None,
             None if i % 13 == 0 else float("nan") if i % 17 == 0 else float(i * 37 % 101))
            for i in range(200)]
    table = spark.createDataFrame(data, "ts timestamp_ntz, id bigint, key string, value double")
    table.repartition(files).write.parquet(f"{folder}/in")
    source = parquet_stream(spark, f"{folder}/in", table.schema, max_files=1)
    for _ in range(2):  # started again, it finds nothing new
        rollup.start_bars(source, f"{folder}/out", f"{folder}/c", "ts", "key", "value",
                          F.col("id")).awaitTermination()
    kept = rollup.bar_schema(spark, table.schema, "ts", "key", "value", F.col("id"))
    if compacted:
        assert rollup.compact_bars(spark, f"{folder}/out", "key", kept) >= 2
    bars = rollup.read_bars(spark, f"{folder}/out", "key", kept)
    assert rows(bars) == rows(rollup.hourly_bars(table, "ts", "key", "value", F.col("id")))
    closed = rollup.closed_bars(bars, F.lit(dt.datetime(2026, 1, 1, 23, 59)).cast("timestamp_ntz"),
                                dt.timedelta(hours=2))
    assert {row["window_start"].hour for row in closed.collect()} == set(range(21))


def test_bars_are_of_utc_in_any_session_zone(spark):
    table = spark.createDataFrame([(1, 5.0)], "id bigint, value double").select(
        "*", F.lit("k").alias("key"), F.timestamp_seconds(F.lit(1_767_225_600)).alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        bar = rollup.hourly_bars(table, "ts", "key", "value", F.col("id")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert bar["window_start"] == AT
