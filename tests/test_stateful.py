"""Streams that remember: repeats across micro-batches, and scores against the days before."""

import datetime as dt
import os
import random
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from frames import rows
from millrace.sources.streams import parquet_stream
from millrace.streaming import anomalies, dedup

AT = dt.datetime(2026, 1, 1)
SENT = "id long, t timestamp_ntz, v int"


def deliver(spark, folder, data, schema, number):
    """One file, later than those before it."""
    path = f"{folder}/in"
    before = set(os.listdir(path)) if os.path.isdir(path) else set()
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - before:
        os.utime(f"{path}/{name}", (1_700_000_000 + number, 1_700_000_000 + number))


def unique(spark, folder, schema=SENT, within="10 minutes"):
    stream = parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema, max_files=1)
    run = dedup.start_dedup(stream, f"{folder}/out", f"{folder}/checkpoint", "id", "t", within)
    run.awaitTermination()
    return dedup.dedup_report(run.recentProgress)


def minute(n):
    return AT + dt.timedelta(minutes=n)


def test_repeats_in_and_across_batches(spark, folder):
    """A hot key, rows without a key or a time, and rows that come too late."""
    hot = [(7, minute(1), 0)] * 500
    deliver(spark, folder, [(1, minute(0), 1), (1, minute(0), 1), (None, minute(0), 1), (None, minute(0), 1),
                            (None, minute(0), 2), *hot], SENT, 0)
    deliver(spark, folder, [(1, minute(0), 1), (2, minute(15), 1), (None, minute(0), 2), (3, None, 1), *hot], SENT, 1)
    deliver(spark, folder, [(2, minute(15), 1), (4, minute(60), 1)], SENT, 2)
    deliver(spark, folder, [(5, minute(50), 1), (5, minute(51), 2)], SENT, 3)
    deliver(spark, folder, [(1, minute(0), 1), (6, minute(2), 1), (4, minute(60), 1)], SENT, 4)
    report = unique(spark, folder)
    out = rows(spark.read.parquet(f"{folder}/out"))
    assert sorted(r[0] for r in out if r[0] is not None) == [1, 2, 4, 5, 7]
    assert sorted(r[2] for r in out if r[0] is None) == [1, 2]
    assert (report.rows_in, report.rows_kept, report.rows_late, report.rows_untimed) == (1016, 7, 2, 1)
    assert report.rows_repeated == 1016 - 7 - 2 - 1


def test_a_restart_remembers(spark, folder):
    deliver(spark, folder, [(1, minute(0), 1), (2, minute(0), 1)], SENT, 0)
    assert unique(spark, folder).rows_kept == 2
    deliver(spark, folder, [(1, minute(0), 1), (3, minute(0), 1)], SENT, 1)
    report = unique(spark, folder)
    assert (report.rows_in, report.rows_kept, report.rows_repeated) == (2, 1, 1)
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2, 3]


def test_no_rows(spark, folder):
    deliver(spark, folder, [], SENT, 0)
    assert unique(spark, folder).rows_in == 0


def test_state_expires(spark, folder):
    """What is kept is bounded by the span, not by the number of keys ever seen."""
    for batch in range(6):
        deliver(spark, folder, [(batch * 100 + k, minute(60 * batch), 1) for k in range(100)], SENT, batch)
    stream = parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], SENT).schema, max_files=1)
    run = dedup.start_dedup(stream, f"{folder}/out", f"{folder}/checkpoint", "id", "t", "10 minutes")
    run.awaitTermination()
    assert run.recentProgress[-1].stateOperators[0].numRowsTotal <= 200
    assert spark.read.parquet(f"{folder}/out").count() == 600


VALUES = "n int, t timestamp_ntz, k string, v double"


def scores(data, limit=3.0):
    out = []
    for n, t, k, v in data:
        there = v is not None and v == v
        known = [w for _, s, j, w in data if s and t and s.date() < t.date() and j == k and w is not None and w == w]
        z = (v - mean(known)) / stdev(known) if there and len(known) > 1 and stdev(known) > 0 else None
        out.append((n, None if z is None else round(z, 6), z is not None and abs(z) > limit))
    return sorted(out)


@pytest.fixture(scope="module")
def values():
    """Ten days in order of time, with a third of the rows in one key, NULL keys, values that
    are missing, large means, a constant key and rows without a time."""
    rng = random.Random(5)
    data = []
    for n in range(400):
        k = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None, "same"])
        v = 5.0 if k == "same" else 1e6 + rng.gauss(0, 1) * (50 if rng.random() < 0.03 else 1)
        data.append((n, AT + dt.timedelta(hours=n * 240 / 400), k, rng.choice([v] * 20 + [None, float("nan")])))
    return [(n, None if n % 97 == 5 else t, k, v) for n, t, k, v in data]


@pytest.mark.parametrize("batches", [1, 4, 16])
def test_scores_do_not_depend_on_batches(spark, folder, values, batches):
    step = -(-len(values) // batches)
    for b in range(batches):
        deliver(spark, folder, values[b * step:(b + 1) * step], VALUES, b)
    stream = parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], VALUES).schema, max_files=1)
    anomalies.start_anomalies(stream, f"{folder}/out", f"{folder}/c", "t", "k", "v").awaitTermination()
    got = sorted(map(tuple, anomalies.read_scored(spark, f"{folder}/out", stream.schema).select("n", "z_score", "is_anomaly").collect()))
    want = scores(values)
    assert [(n, flag) for n, _, flag in got] == [(n, flag) for n, _, flag in want]
    for (_, a, _), (_, b, _) in zip(got, want):
        assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-5 * max(1, abs(b)))
    assert sum(flag for _, _, flag in want) > 3


def test_a_replayed_batch_scores_the_same(spark, folder, values):
    """Written twice, as after a failure between the two slices."""
    def run(name, times):
        def twice(batch, batch_id):
            write = anomalies.anomaly_writer(f"{folder}/{name}", "t", "k", "v")
            for _ in range(times):
                write(batch, batch_id)
        stream = parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], VALUES).schema, max_files=1)
        stream.writeStream.foreachBatch(twice).option("checkpointLocation", f"{folder}/{name}-c").trigger(
            availableNow=True).start().awaitTermination()
        return rows(anomalies.read_scored(spark, f"{folder}/{name}", stream.schema).select("n", F.round("z_score", 9), "is_anomaly"))
    for b in range(2):
        deliver(spark, folder, values[b * 200:(b + 1) * 200], VALUES, b)
    assert run("once", 1) == run("again", 2)


def test_an_empty_stream_has_no_scores(spark, folder):
    deliver(spark, folder, [], VALUES, 0)
    stream = parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], VALUES).schema)
    anomalies.start_anomalies(stream, f"{folder}/out", f"{folder}/c", "t", "k", "v").awaitTermination()
    assert anomalies.read_scored(spark, f"{folder}/out", stream.schema).columns == ["n", "t", "k", "v", "z_score", "is_anomaly"]
    assert anomalies.read_scored(spark, f"{folder}/out", stream.schema).count() == 0
