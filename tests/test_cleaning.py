import math

import pytest
from pyspark.sql import functions as F

from frames import rows
from millrace.contracts import ALPHA, BETAS
from millrace.operators import cleaning
from millrace.operators import sampling
from millrace.operators.sampling import BUCKET_ROWS, sample_rows, side_of
from millrace.sources.synthetic import ROW_KEY, generate_linear, pollute

NAN = float("nan")
SCHEMA = "a double, b string"


def test_null_nan_and_signed_zero_copies(spark):
    df = spark.createDataFrame([(NAN, "x"), (NAN, "x"), (None, "x"), (None, "x"), (0.0, "z"),
                                (-0.0, "z")], SCHEMA)
    assert cleaning.drop_copies(df).count() == 3


def test_clean_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (1.0, "x"), (NAN, "x"), (None, "x"), (2.0, None)], SCHEMA)
    assert rows(cleaning.clean(df)) == [(1.0, "x")]
    assert rows(cleaning.drop_missing(df, ["a"])) == [(1.0, "x"), (1.0, "x"), (2.0, None)]


def test_order_of_the_two_steps_does_not_matter(spark):
    df = spark.createDataFrame([(1.0, "x"), (1.0, "x"), (NAN, "x"), (2.0, "y")], SCHEMA)
    other = cleaning.drop_missing(cleaning.drop_copies(df))
    assert rows(cleaning.clean(df)) == rows(other)


def test_report(spark):
    df = spark.createDataFrame([(1.0, "x"), (1.0, "x"), (NAN, "x"), (NAN, "x"), (2.0, "y")], SCHEMA)
    assert cleaning.cleaning_report(df).first().asDict() == {
        "rows_before": 5, "distinct_rows": 3, "rows_after": 2, "dropped_rows": 3}
    assert tuple(cleaning.cleaning_report(df.limit(0)).first()) == (0, 0, 0, 0)


def test_null_rows(spark):
    df = spark.createDataFrame([(1.0, "x"), (NAN, None), (2.0, None)], SCHEMA)
    assert tuple(cleaning.null_rows(df).first()) == (2, 3)


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, "x"), (1.0, "x")], "`a.b` double, `c d` string")
    assert rows(cleaning.clean(df)) == [(1.0, "x")]
    assert cleaning.cleaning_report(df).first()["rows_after"] == 1


def test_known_answer_counts(spark):
    raw = pollute(generate_linear(spark, 100), ROW_KEY)
    assert raw.columns == ["x_1", "x_2", "x_3", "x_4", "y"]
    assert raw.count() == 108
    assert cleaning.clean(raw).count() == 100
    assert 5 <= cleaning.null_rows(raw).first()["null_rows"] <= 8


def test_generated_rows_are_linear_and_uniform(spark):
    df = generate_linear(spark, 20_000)
    assert df.select(ROW_KEY).distinct().count() == 20_000
    low, high, mean = df.agg(F.min("x_3"), F.max("x_3"), F.avg("x_3")).first()
    assert 0 <= low < 0.001 and 0.999 < high < 1 and abs(mean - 0.5) < 0.01
    assert abs(df.corr("x_1", "x_2")) < 0.03
    for row in df.limit(5).collect():
        y = sum(b * row[f"x_{i + 1}"] for i, b in enumerate(BETAS)) + ALPHA
        assert math.isclose(row["y"], y)


def test_generated_rows_depend_on_the_seed_not_on_partitions(spark):
    a = generate_linear(spark, 50, seed=1)
    assert rows(a) == rows(generate_linear(spark, 50, seed=1).repartition(7))
    assert rows(a) != rows(generate_linear(spark, 50, seed=2))


def test_more_features_than_one_digest_holds(spark):
    df = generate_linear(spark, 10, betas=[1.0] * 6, alpha=0.0)
    assert df.columns[1:-1] == [f"x_{i}" for i in range(1, 7)]
    assert len(set(df.first()[1:7])) == 6


@pytest.mark.parametrize("n", [1, 4, 5, 100])
def test_sample_has_exactly_n_rows_and_is_reproducible(spark, n):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    one = rows(sample_rows(df, "id", n, seed=3))
    assert sorted(row[0] for row in one) == list(range(n))
    assert all(row[2] == 2 * row[1] for row in one)
    assert one == rows(sample_rows(df.repartition(5), "id", n, seed=3))


def test_sample_with_replacement_can_exceed_the_table(spark):
    assert sample_rows(spark.range(2), "id", 9).count() == 9


def test_sample_of_nothing(spark):
    assert sample_rows(spark.range(0), "id", 3).count() == 0
    assert sample_rows(spark.range(0), "id", 300).count() == 0
    assert sample_rows(spark.range(5), "id", 0).columns == ["draw", "id"]


def test_large_sample_is_even(spark):
    drawn = sample_rows(spark.range(10), "id", 5000, seed=1)
    counts = {row["id"]: row["count"] for row in drawn.groupBy("id").count().collect()}
    assert sum(counts.values()) == 5000 and len(counts) == 10
    assert sum((n - 500) ** 2 / 500 for n in counts.values()) < 30  # 9 degrees of freedom


def test_small_sample_is_even(spark):
    drawn = [row["id"] for seed in range(40) for row in
             sample_rows(spark.range(4), "id", 4, seed).collect()]
    assert all(20 <= drawn.count(i) <= 62 for i in range(4))


def test_a_smaller_sample_is_the_start_of_a_larger_one(spark):
    df = spark.range(5000)
    assert rows(sample_rows(df, "id", 4)) == rows(sample_rows(df, "id", 300).where("draw < 4"))


def test_rows_without_a_key_are_refused(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "id int")
    with pytest.raises(ValueError, match="1 rows have no id"):
        sample_rows(df, "id", 2)


@pytest.mark.parametrize("key", ["id", "name"])
def test_both_ways_draw_the_same_rows(spark, monkeypatch, key):
    df = spark.range(3000).withColumn("name", F.concat(F.lit("n"), "id"))
    few = rows(sample_rows(df, key, 40))
    monkeypatch.setattr(sampling, "FEW_DRAWS", 0)
    assert rows(sample_rows(df, key, 40)) == few and len(few) == 40


@pytest.mark.parametrize("few", [0, 1000])
def test_a_repeated_key_is_refused(spark, monkeypatch, few):
    monkeypatch.setattr(sampling, "FEW_DRAWS", few)
    with pytest.raises(ValueError, match="does not identify"):
        sample_rows(spark.range(10).union(spark.range(10)), "id", 5).count()


def test_few_draws_read_their_rows_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = sample_rows(df, "event_id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_id" in plan and "BroadcastHashJoin" in plan and "Exchange hash" not in plan


def test_buckets_grow_with_the_table():
    assert [side_of(n) for n in (0, 1, BUCKET_ROWS, BUCKET_ROWS * 4, BUCKET_ROWS * 5)] == [1, 1, 1, 2, 4]
