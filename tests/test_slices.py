"""Publishing after an audit of what was written, and tables of buckets."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from frames import rows
from millrace.operators import audit, capture
from millrace.operators.quality import CheckFailed
from millrace.plans import jobs
from millrace.sinks import slices

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])


def frame(spark, data):
    return spark.createDataFrame(data, ROW).repartition(4)


def counted(spark, df):
    """The frame, and an accumulator of how many of its rows were computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(count, df.schema), seen


def test_the_input_is_read_once(spark, folder):
    good, seen = counted(spark, frame(spark, [(i, 1.0) for i in range(100)]))
    assert jobs.published_once(good, folder, "a", ["k", "v"]) == (True, 100) and seen.value == 100
    bad, seen = counted(spark, frame(spark, [(i, None) for i in range(100)]))
    assert jobs.published_once(bad, folder, "b", ["k", "v"]) == (False, 0) and seen.value == 100
    assert rows(slices.read_slices(spark, folder, ROW).groupBy("slice").count()) == [("a", 100)]


def test_a_failed_check_shows_nothing_and_hides_nothing(spark, folder):
    slices.create_slices(spark, folder)
    bad = frame(spark, [(1, 1.0), (2, float("nan")), (None, 3.0)])
    for _ in range(2):
        with pytest.raises(CheckFailed) as failure:
            slices.publish_observed(bad, folder, "r", ["k", "v"])
        assert failure.value.report["nulls_by_column"] == {"k": 1, "v": 1}
        assert slices.read_slices(spark, folder, ROW).count() == 0
    slices.publish_observed(bad.where("k = 1"), folder, "r", ["k", "v"])
    with pytest.raises(CheckFailed):
        slices.publish_observed(bad, folder, "r", ["k"])
    assert rows(slices.read_slices(spark, folder, ROW)) == [(1, 1.0, "r")]


def test_a_retry_replaces_its_run_only(spark, folder):
    slices.create_slices(spark, folder)
    for run, data in (("1", [(1, 1.0)]), ("2", [(2, 2.0)]), ("1", [(3, 3.0), (4, 4.0)])):
        assert slices.publish_observed(frame(spark, data), folder, run, ["k"])["total_rows"] == len(data)
    assert rows(slices.read_slices(spark, folder, ROW)) == [(2, 2.0, "2"), (3, 3.0, "1"), (4, 4.0, "1")]
    assert rows(slices.read_slices(spark, folder, ROW, ["2"])) == [(2, 2.0, "2")]


def test_a_write_that_dies_before_its_commit_is_not_seen(spark, folder, monkeypatch):
    slices.create_slices(spark, folder)
    with monkeypatch.context() as patch:
        patch.setattr(slices, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            slices.publish_observed(frame(spark, [(1, 1.0)]), folder, "r", ["k"])
    assert slices.read_slices(spark, folder, ROW).count() == 0
    slices.publish_observed(frame(spark, [(1, 1.0)]), folder, "r", ["k"])
    assert slices.read_slices(spark, folder, ROW).count() == 1


def test_empty_tables(spark, folder):
    slices.create_slices(spark, folder)
    none = frame(spark, [])
    assert slices.publish_observed(none, folder, "r", ["k"])["passed"]
    with pytest.raises(CheckFailed, match="empty"):
        slices.publish_observed(none, folder, "r", ["k"], fail_on_empty=True)
    with pytest.raises(ValueError, match="run name"):
        slices.publish_observed(none, folder, "a/b", ["k"])
    assert slices.read_slices(spark, folder, ROW).columns == ["k", "v", "slice"]


CHANGES = "k int, v double, seq int, op string"


def files(spark, path):
    shown = capture.read_buckets(spark, path, ROW).select("slice", F.input_file_name()).distinct()
    return {int(name): file for name, file in rows(shown)}


def test_only_touched_buckets_are_rewritten(spark, folder):
    base = frame(spark, [(i, float(i)) for i in range(300)] + [(None, -1.0)] * 40)
    capture.write_buckets(base, folder, "k", 16)
    before = files(spark, folder)
    assert len(before) == 16
    changes = spark.createDataFrame([(5, 0.5, 1, "U"), (5, 5.5, 2, "U"), (6, None, 1, "D"), (999, 9.0, 1, "I"),
                                     (7, 0.0, 1, "X"), (None, 0.0, 1, "U")], CHANGES)
    touched = capture.apply_to_buckets(spark, folder, ROW, changes, "k", ["seq"])
    after = files(spark, folder)
    assert 1 <= len(touched) <= 3
    assert {b for b in before if before[b] != after.get(b)} == set(touched)
    want = sorted([(i, float(i)) for i in range(300) if i not in (5, 6)] + [(5, 5.5), (999, 9.0)])
    got = rows(capture.read_buckets(spark, folder, ROW).drop("slice"))
    assert sorted(r for r in got if r[0] is not None) == want and got.count((None, -1.0)) == 40


def test_buckets_against_the_whole_table(spark, folder):
    """Round after round, with a key that holds a third of the changes and buckets that empty."""
    rng, base = random.Random(1), frame(spark, [(i, 0.0) for i in range(30)])
    capture.write_buckets(base, folder, "k", 8)
    for turn in range(3):
        changes = spark.createDataFrame(
            [(7 if rng.random() < 0.33 else rng.randrange(40), float(turn), seq, rng.choice("IUDD"))
             for seq in range(60)], CHANGES)
        base = spark.createDataFrame(capture.apply_changes(base, changes.withColumn("k", F.col("k").cast("long")),
                                                           "k", ["seq"]).collect(), ROW)
        for _ in range(2):
            capture.apply_to_buckets(spark, folder, ROW, changes, "k", ["seq"])
        assert rows(capture.read_buckets(spark, folder, ROW).drop("slice")) == rows(base)
    gone = spark.createDataFrame([(i, None, 1, "D") for i in range(40)], CHANGES)
    capture.apply_to_buckets(spark, folder, ROW, gone, "k", ["seq"])
    assert capture.read_buckets(spark, folder, ROW).count() == 0
    capture.apply_to_buckets(spark, folder, ROW, spark.createDataFrame([(3, 1.0, 1, "I")], CHANGES), "k", ["seq"])
    assert rows(capture.read_buckets(spark, folder, ROW).drop("slice")) == [(3, 1.0)]
    assert capture.apply_to_buckets(spark, folder, ROW, gone.limit(0), "k", ["seq"]) == []


def test_an_interrupted_change_leaves_the_table_as_it_was(spark, folder, monkeypatch):
    capture.write_buckets(frame(spark, [(1, 1.0), (2, 2.0)]), folder, "k", 4)
    changes = spark.createDataFrame([(1, None, 1, "D"), (2, 9.0, 1, "U")], CHANGES)
    with monkeypatch.context() as patch:
        patch.setattr(slices, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            capture.apply_to_buckets(spark, folder, ROW, changes, "k", ["seq"])
    assert rows(capture.read_buckets(spark, folder, ROW).drop("slice")) == [(1, 1.0), (2, 2.0)]
    capture.apply_to_buckets(spark, folder, ROW, changes, "k", ["seq"])
    assert rows(capture.read_buckets(spark, folder, ROW).drop("slice")) == [(2, 9.0)]


def test_rows_are_reconciled_by_content(spark):
    left = frame(spark, [(1, 1.0), (2, 2.0), (2, 2.0), (3, 3.0), (4, None), (None, 1.0), (None, 2.0)]
                 + [(9, float(i % 5)) for i in range(200)])
    right = frame(spark, [(1, 1.0), (2, 2.0), (3, 3.5), (4, None), (5, 5.0), (None, 1.0), (None, 3.0)]
                  + [(9, float(i % 5)) for i in range(201)])
    assert rows(audit.reconcile_rows(left, right, "k")) == [
        (2, "missing", 1, 0), (3, "changed", 1, 1), (5, "extra", 0, 1), (9, "extra", 0, 1), (None, "changed", 1, 1)]
    shuffled = left.orderBy(F.desc("v")).select("v", "k")
    assert audit.reconcile_rows(left, shuffled, "k").count() == 0
    assert rows(audit.reconcile_rows(left.limit(0), left.where("k = 1"), "k")) == [(1, "extra", 0, 1)]
    assert audit.reconcile_rows(left.limit(0), right.limit(0), "k").count() == 0
    with pytest.raises(ValueError, match="different columns"):
        audit.reconcile_rows(left, right.drop("v"), "k")


def test_only_differing_buckets_are_compared(spark, folder):
    data = [(i, float(i)) for i in range(500)]
    for name, rows_of in (("left", data), ("right", data[:-1] + [(499, 0.0)])):
        capture.write_buckets(frame(spark, rows_of), f"{folder}/{name}", "k", 32)
    sides = [capture.read_buckets(spark, f"{folder}/{name}", ROW) for name in ("left", "right")]
    assert len(audit.differing_buckets(*sides, "k", 32, "slice")) == 1
    found = audit.reconcile_rows(*sides, "k", bucket="slice")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(slice") == 2 or plan.count("cast(slice") == 2
    assert rows(found) == [(499, "changed", 1, 1)]


def as_of(facts, known):
    """The plain result: the last dimension row not after the time, the greatest of equal ones."""
    out = []
    for n, k, at in facts:
        usable = [(since, v) for key, since, v in known if None not in (k, at, since) and key == k and since <= at]
        out.append((n, k, at, max(usable)[1] if usable else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_enrichment_as_of_a_time(spark, parts):
    """NULL keys and times, ties, rows before the first known value, and a key that holds a
    third of the rows, many of them at one time."""
    rng = random.Random(int(parts))
    facts = [(n, 1 if rng.random() < 0.4 else rng.choice([None, 2, 3, 4]),
              50 if rng.random() < 0.2 else rng.choice([None, *range(100)])) for n in range(400)]
    known = [(rng.choice([1, 1, 2, 3, None, 5]), rng.choice([None, *range(10, 90, 7)]), rng.randrange(1000))
             for _ in range(60)]
    settings = {"spark.sql.shuffle.partitions": parts, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    former = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = spark.createDataFrame(facts, "n int, k int, t int")
        dimension = spark.createDataFrame(known, "k int, since int, v int")
        got = audit.enrich_as_of(df, dimension, "k", "t", "since", ["v"])
        assert got.columns == ["n", "k", "t", "v"] and rows(got) == as_of(facts, known)
        assert audit.enrich_as_of(df.limit(0), dimension, "k", "t", "since", ["v"]).count() == 0
        assert rows(audit.enrich_as_of(df, dimension.limit(0), "k", "t", "since", ["v"])) == as_of(facts, [])
    finally:
        for name, value in former.items():
            spark.conf.set(name, value)
