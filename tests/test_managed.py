"""Ingest into a table with keys and insert times, replays, and compaction."""

import datetime as dt
import os
from glob import glob

import pytest
from pyspark.sql import functions as F

from frames import rows
from millrace import queries
from millrace.operators import change
from millrace.plans import jobs
from millrace.sources.streams import json_lines_stream, parquet_stream
from millrace.streaming import managed
from millrace.streaming.ingest import BatchReport, start_stream

GOOD = '{"coin":"%s","usd":1,"eur":2,"timestamp":"2026-01-01T00:00:00+00:00"}'


class Inbox:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.path, self.reports, self.sent = spark, folder, f"{folder}/table", [], 0
        os.makedirs(f"{folder}/in")

    def send(self, *lines):
        name = f"{self.folder}/in/{self.sent:04d}"
        with open(name, "w") as file:
            file.write("\n".join(lines) + "\n" if lines else "")
        os.utime(name, (1_700_000_000 + self.sent, 1_700_000_000 + self.sent))
        self.sent += 1

    def run(self, checkpoint="c", writer=None):
        source = json_lines_stream(self.spark, f"{self.folder}/in", 1)
        managed.create_managed(self.spark, self.path)
        writer = writer or managed.managed_writer(self.path, self.reports.append)
        start_stream(source, writer, f"{self.folder}/{checkpoint}", interval=None).awaitTermination()

    def coins(self):
        return [r["coin"] for r in managed.read_managed(self.spark, self.path).orderBy("id").collect()]

    def ids(self):
        return [r["id"] for r in managed.read_managed(self.spark, self.path).collect()]


@pytest.fixture
def inbox(spark, folder):
    return Inbox(spark, folder)


def test_rows_have_keys_and_times(inbox, spark):
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    inbox.send(GOOD % "a", "broken", GOOD % "b")
    inbox.send(GOOD % "c", '{"usd":1}')
    inbox.run()
    table = managed.read_managed(spark, inbox.path)
    assert table.columns == ["id", "coin", "usd", "eur", "event_timestamp", "inserted_at"]
    assert inbox.coins() == ["a", "b", "c"] and len(set(inbox.ids())) == 3
    assert all(before <= r["inserted_at"] <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
               for r in table.collect())
    assert inbox.reports == [BatchReport(0, 3, 2, 1), BatchReport(1, 2, 1, 1)]
    assert rows(managed.read_rejects(spark, inbox.path).drop("inserted_at")) == [
        (None, "broken", "malformed"), (None, '{"usd":1}', "missing_key")]
    assert rows(managed.managed_batches(spark, inbox.path).drop("stream_id")) == [(0, 0, 3, 2), (1, 1, 2, 1)]


def test_nothing_sent(inbox, spark):
    inbox.run()
    assert inbox.coins() == [] and managed.compact(spark, inbox.path) == 0
    inbox.send()
    inbox.run()
    assert inbox.coins() == []


def replaying(path, times):
    """A writer that writes each batch several times, as after failures."""
    write = managed.managed_writer(path)

    def again(batch, batch_id):
        for _ in range(times):
            write(batch, batch_id)
    return again


def test_a_replay_replaces_its_batch_before_and_after_compaction(inbox, spark):
    for coin in "abcd":
        inbox.send(GOOD % coin, GOOD % coin.upper())
    inbox.run(writer=replaying(inbox.path, 2))
    assert inbox.coins() == list("aAbBcCdD") and len(set(inbox.ids())) == 8
    before = sorted(inbox.ids())
    assert managed.compact(spark, inbox.path) == 3
    assert sorted(inbox.ids()) == before and inbox.coins() == list("aAbBcCdD")
    inbox.send(GOOD % "e")
    inbox.run(writer=replaying(inbox.path, 3))
    assert inbox.coins() == list("aAbBcCdDe") and len(set(inbox.ids())) == 9
    # The last batch before the compaction, replayed after it.
    stream = managed.managed_batches(spark, inbox.path).first()["stream_id"]
    sc = spark.sparkContext
    sc.setLocalProperty("sql.streaming.queryId", stream)
    try:
        from millrace.operators.parsing import sort_messages
        late = spark.createDataFrame([(GOOD % "e",)], "value string")
        managed.managed_writer(inbox.path)(sort_messages(late), 4)
    finally:
        sc.setLocalProperty("sql.streaming.queryId", None)
    assert inbox.coins() == list("aAbBcCdDe") and len(set(inbox.ids())) == 9


def test_compactions_gather_what_is_new(inbox, spark):
    for n in range(3):
        for k in range(3):
            inbox.send(GOOD % f"{n}{k}")
        inbox.run()
        ids = sorted(inbox.ids())
        assert managed.compact(spark, inbox.path) == (2 if n == 0 else 3)
        assert sorted(inbox.ids()) == ids and len(set(ids)) == 3 * (n + 1)
    assert rows(managed.managed_batches(spark, inbox.path).select("first_batch", "last_batch", "rows_in")) == [
        (0, 1, 2), (2, 4, 3), (5, 7, 3), (8, 8, 1)]
    assert managed.compact(spark, inbox.path) == 0
    listed = managed.read_managed(spark, inbox.path).inputFiles()
    assert len({os.path.dirname(file) for file in listed}) == 4


def test_an_interrupted_compaction_changes_nothing(inbox, spark, monkeypatch):
    for coin in "abc":
        inbox.send(GOOD % coin)
    inbox.run()
    ids = sorted(inbox.ids())
    with monkeypatch.context() as patch:
        patch.setattr(managed.batches, "commit_batch", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            managed.compact(spark, inbox.path)
    assert inbox.coins() == ["a", "b", "c"] and sorted(inbox.ids()) == ids


def test_a_stream_without_its_checkpoint_overwrites_nothing(inbox, spark):
    inbox.send(GOOD % "a")
    inbox.run("one")
    inbox.run("two")
    assert inbox.coins() == ["a", "a"] and len(set(inbox.ids())) == 2
    for _ in range(2):
        inbox.send(GOOD % "b")
    inbox.run("one")
    assert managed.compact(spark, inbox.path) == 2 and sorted(inbox.coins()) == ["a", "a", "b", "b"]
    assert len(set(inbox.ids())) == 4


def test_the_log_is_the_only_join(inbox, spark):
    inbox.send(GOOD % "a")
    inbox.run()
    plan = managed.read_managed(spark, inbox.path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "BroadcastHashJoin" in plan and plan.count("FileScan") == 1


def test_a_snapshot_is_a_place_in_the_log(inbox, spark):
    inbox.run()
    assert managed.snapshot_state(spark, inbox.path) == (-1, 0)
    for coin in "abc":
        inbox.send(GOOD % coin, "broken")
    inbox.run()
    number, count = managed.snapshot_state(spark, inbox.path)
    ids = sorted(inbox.ids())
    assert count == 3
    inbox.send(GOOD % "d")
    inbox.run()
    managed.compact(spark, inbox.path)
    assert managed.snapshot_state(spark, inbox.path)[1] == 4
    then = managed.read_managed(spark, inbox.path, number)
    assert sorted(r["id"] for r in then.collect()) == ids and len(inbox.ids()) == 4


def test_snapshots_of_managed_tables_follow_growth(inbox, spark, folder):
    change.create_cursors(spark, f"{folder}/cursors")

    def poll():
        return jobs.snapshot_managed(spark, "prices", inbox.path, f"{folder}/cursors")
    inbox.run()
    assert poll() is None
    inbox.send(GOOD % "a", GOOD % "b")
    inbox.run()
    first = poll()
    assert first and poll() is None
    inbox.send(GOOD % "c")
    inbox.run()
    assert jobs.read_managed_snapshot(spark, "prices", f"{folder}/cursors").count() == 2
    assert poll() not in (None, first)
    managed.compact(spark, inbox.path)
    assert jobs.read_managed_snapshot(spark, "prices", f"{folder}/cursors").count() == 3
    assert jobs.read_managed_snapshot(spark, "other", f"{folder}/cursors") is None


def test_a_delivery_is_one_batch_in_several_files(spark, folder):
    """By time, not by the order of the rows, which all tasks have some of."""
    df = spark.range(0, 400, 1, 4).select("id", F.when(F.col("id") != 0, F.timestamp_seconds(F.col("id") % 100)).alias("at"))
    seen, files = [], []
    for stream in queries.in_time_order(df, f"{folder}/in", "at"):
        files.append(len(glob(f"{folder}/in/*.parquet")))
        stream.writeStream.foreachBatch(lambda batch, n: seen.append((n, sorted(r["id"] for r in batch.collect())))).option(
            "checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    assert seen == [(k, [n for n in range(400) if n % 100 // 25 == k]) for k in range(4)]
    assert files == [4, 8, 12, 16]


def test_deliveries_without_rows_or_times(spark, folder):
    for name, ids in (("none", []), ("untimed", [1, 2])):
        df = spark.createDataFrame([(n, None) for n in ids], "id long, at timestamp")
        seen = []
        for stream in queries.in_time_order(df, f"{folder}/{name}", "at"):
            stream.writeStream.foreachBatch(lambda batch, n: seen.append((n, batch.count()))).option(
                "checkpointLocation", f"{folder}/{name}-c").trigger(availableNow=True).start().awaitTermination()
        assert seen == [(0, len(ids)), (1, 0), (2, 0), (3, 0)]


def by_lower_keys(*args, commit=managed.batches.commit_batch):
    """Batches get keys below those of the batch before; compactions are left alone."""
    *most, (first, last), rows_in, accepted, first_ids, next_id = args
    if first_ids is not None:
        first_ids = [10 ** 9 - first * 10 ** 6 + 10 ** 4 * task for task in range(len(first_ids))]
    commit(*most, (first, last), rows_in, accepted, first_ids, next_id)


def backwards(df, path, time, parts):
    """Deliveries of rows of earlier and earlier times."""
    for k in reversed(range(parts)):
        df.where(F.floor(F.col("event_id") * parts / 80) == k).write.mode("append").parquet(path)
        yield parquet_stream(df.sparkSession, path, df.schema)


@pytest.mark.parametrize("wrong", ["nothing", "keys", "deliveries"])
def test_the_order_of_keys_is_told_from_the_rows(spark, folder, monkeypatch, wrong):
    """Of 80 rows, some come twice and some are rejects; one delivery of six has nothing to accept."""
    n = F.col("id")
    spark.range(80).select(
        n.alias("event_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=n)).alias("ts"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.when(n.between(20, 39), 0).otherwise(n % 7 + 2)).alias("props"),
        F.explode(F.sequence(F.lit(1), n % 2 + 1))).drop("col").write.parquet(f"{folder}/events.parquet")
    if wrong == "keys":
        monkeypatch.setattr(managed.batches, "commit_batch", by_lower_keys)
    if wrong == "deliveries":
        monkeypatch.setattr(queries, "in_time_order", backwards)
    found = queries.stream_managed_ids(spark, folder).first()
    assert found["in_order"] is (wrong == "nothing")
    assert found["rows_in"] == 140 and found["rows_accepted"] == found["distinct_ids"] == 140 - found["rows_rejected"]


# Batches of which the second has no accepted row; the third and fourth are sent again.
SENT = [BatchReport(0, 2, 2, 0), BatchReport(1, 1, 0, 1), BatchReport(2, 3, 2, 1), BatchReport(3, 1, 1, 0)]
KEPT = [(0, 1, 10), (1, 1, 11), (5, 2, 10), (6, 2, 12), (7, 3, 13)]


@pytest.mark.parametrize("rows_kept, again, ok", [
    (KEPT, 2, True), ([], 2, False), (KEPT[:4], 2, False),
    (KEPT, 3, False),  # the times begin anew too early
    ([(9, 1, 10), *KEPT[1:]], 2, False),  # a key of the first batch above all others
    ([*KEPT[:4], (4, 3, 13)], 2, False),  # a key of the last batch among those before
    ([(1, 1, 11), *KEPT[1:]], 2, True),  # keys that occur twice in a batch are counted elsewhere
    ([*KEPT[:4], (6, 3, 13)], 2, False),  # but not in two
    ([*KEPT[:4], (7, 3, 12)], 2, False),  # no later time
    ([*KEPT[:3], (6, 3, 12), (7, 3, 13)], 2, False),  # other numbers of rows than were reported
])
def test_keys_and_times_ascend_from_batch_to_batch(spark, rows_kept, again, ok):
    table = spark.createDataFrame(rows_kept, "id long, batch long, time long").select(
        "id", *[F.timestamp_seconds(c).cast("timestamp_ntz").alias(name)
                for c, name in (("batch", "inserted_at"), ("time", "event_timestamp"))])
    assert queries._in_order(table, SENT, again).first()["in_order"] is ok


def test_no_rows_are_in_order(spark):
    table = spark.createDataFrame([], "id long, inserted_at timestamp_ntz, event_timestamp timestamp_ntz")
    for reports in ([], [BatchReport(0, 0, 0, 0), BatchReport(1, 1, 0, 1)]):
        assert queries._in_order(table, reports, 4).first()["in_order"] is True
