import numpy as np
import pytest

from frames import rows
from millrace.operators import moments, regression
from millrace.operators.moments import Moments
from millrace.plans import jobs
from millrace.sinks.files import append_run, read_runs

NAMES = ["x_1", "x_2", "y"]


def frame(spark, data):
    return spark.createDataFrame([tuple(map(float, row)) for row in data], "x_1 double, x_2 double, y double")


def table(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [1, 1e3] + [1e6, -5]
    return np.column_stack([x, x @ [2, 0.5] + rng.normal(size=n)])


def test_moments_against_numpy(spark):
    data = table(400, 1)
    found = moments.moments(frame(spark, data).repartition(7), NAMES)
    centred = data - data.mean(axis=0)
    assert found.rows == 400 and found.incomplete == 0 and found.nulls == (0, 0, 0)
    assert np.allclose(found.means, data.mean(axis=0), rtol=1e-12)
    assert np.allclose(found.products, centred.T @ centred, rtol=1e-8)


def test_missing_values_are_counted(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (float("nan"), None, 1.0), (1.0, 1.0, 1.0)],
                               "x_1 double, x_2 double, y double")
    found = moments.moments(df, NAMES)
    assert (found.rows, found.incomplete, found.nulls) == (3, 2, (1, 2, 0))
    with pytest.raises(ValueError, match="2 rows"):
        regression.fit_moments(found)
    assert regression.fit_moments(found, []).rows == 3


def test_wide_tables_have_the_same_moments(spark, monkeypatch):
    df = frame(spark, table(200, 2))
    narrow = moments.moments(df, NAMES)
    monkeypatch.setattr(moments, "NARROW", 2)
    wide = moments.moments(df, NAMES)
    assert np.allclose(wide.products, narrow.products, rtol=1e-8) and wide.rows == narrow.rows
    with pytest.raises(ValueError, match="one pass"):
        moments.comoments(df, NAMES)


def test_runs_are_merged(spark, folder):
    """Runs of one row, of no row and of very different means, one of them kept twice."""
    data = np.concatenate([table(300, 3), table(1, 4) + 1e5, table(200, 5) * 10])
    parts = {"a": data[:300], "b": data[300:301], "none": data[:0], "c": data[301:]}
    for run in ("a", "b", "none", "c", "a"):
        append_run(moments.comoments(frame(spark, parts[run]), NAMES), folder, run)
    stored = read_runs(spark, folder)
    assert stored.count() == 4
    merged, whole = Moments.of(moments.merged(stored).first()), moments.moments(frame(spark, data), NAMES)
    assert merged.rows == whole.rows == 501
    assert np.allclose(merged.means, whole.means, rtol=1e-12)
    assert np.allclose(merged.products, whole.products, rtol=1e-9)
    a, b = regression.fit_moments(merged), regression.fit_linear(frame(spark, data))
    assert np.allclose(a.coefficients, b.coefficients, rtol=1e-6) and a.features == b.features
    again = moments.merged(moments.merged(stored).unionByName(stored.where("run_id = 'none'").drop("run_id")))
    assert np.allclose(Moments.of(again.first()).products, whole.products, rtol=1e-9)


def test_runs_of_other_columns_are_refused(spark):
    one = moments.comoments(frame(spark, table(3, 1)), NAMES)
    with pytest.raises(ValueError, match="different columns"):
        moments.merged(one.unionByName(moments.comoments(frame(spark, table(3, 1)), NAMES[:2])))
    with pytest.raises(ValueError, match="no moments"):
        moments.merged(one.limit(0))
    empty = moments.merged(moments.comoments(frame(spark, table(0, 1)), NAMES))
    with pytest.raises(ValueError, match="empty"):
        regression.fit_moments(Moments.of(empty.first()))


def test_a_new_run_reads_its_own_rows_only(spark, folder):
    """The moments of a run need its slice; the fit needs no slice at all."""
    for k, run in enumerate(("1", "2", "3")):
        append_run(frame(spark, table(50, k)), f"{folder}/features", run)
        jobs.moments_job(spark, f"{folder}/features", f"{folder}/moments", run, NAMES)
    own = moments.comoments(jobs.run_slice(spark, f"{folder}/features", "3"), NAMES)
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(run_id" in plan
    whole = regression.fit_linear(read_runs(spark, f"{folder}/features"), ["x_1", "x_2"])
    model = jobs.fit_runs(spark, f"{folder}/moments")
    assert model.rows == 150 and np.allclose(model.coefficients, whole.coefficients, rtol=1e-9)


def test_training_reads_the_table_twice(spark, folder):
    import datetime as dt
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    df = spark.createDataFrame([(float(i), float(i * i % 7), 1.0 + i % 3, 2.0, 3.0 * i) for i in range(60)],
                               "x_1 double, x_2 double, x_3 double, x_4 double, y double")
    jobs.training_job(df.mapInArrow(count, df.schema), f"{folder}/registry", dt.datetime(2026, 1, 1),
                      folder=f"{folder}/models")
    assert seen.value == 120
    assert rows(jobs.run_slice(spark, f"{folder}/registry", "20260101_000000").select("features")) == [
        ('["x_1","x_2","x_3","x_4"]',)]
