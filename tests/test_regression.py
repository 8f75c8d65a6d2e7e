import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.contracts import ALPHA, BETAS
from millrace.operators import regression
from millrace.sources.synthetic import generate_linear


def frame(spark, x, y):
    names = [f"x_{i + 1}" for i in range(x.shape[1])]
    data = [(*map(float, row), float(value)) for row, value in zip(x, y)]
    return spark.createDataFrame(data, ", ".join(f"{n} double" for n in [*names, "y"]))


def test_known_answer(spark):
    df = generate_linear(spark, 100)
    model = regression.fit_linear(df)
    assert model.features == ("x_1", "x_2", "x_3", "x_4") and model.rows == 100
    assert np.allclose(model.coefficients, BETAS, rtol=0, atol=1e-9)
    assert abs(model.intercept - ALPHA) < 1e-9
    assert regression.rmse(df, model).first()["rmse"] < 1e-9


def test_against_least_squares_with_noise(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) * [1, 1e4, 1e-4] + [0, 1e6, 5]
    y = x @ [1, 2, 3] + rng.normal(size=300) - 7
    df = frame(spark, x, y)
    model = regression.fit_linear(df)
    centred = x - x.mean(axis=0)
    expected = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    assert np.allclose(model.coefficients, expected, rtol=1e-6)
    residual = y - x @ expected - (y.mean() - x.mean(axis=0) @ expected)
    rmse = regression.rmse(df, model).first()["rmse"]
    assert np.isclose(rmse, np.sqrt(np.mean(residual ** 2)), rtol=1e-6)


def test_collinear_features_get_the_shortest_solution(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=200), rng.normal(size=200)
    x = np.column_stack([a, 3 * a, b, np.full(200, 4.0)])
    y = 5 * a + 2 * b + 1
    model = regression.fit_linear(frame(spark, x, y))
    centred = x - x.mean(axis=0)
    expected = np.linalg.lstsq(centred, y - y.mean(), rcond=1e-10)[0]
    assert np.allclose(model.coefficients, expected, atol=1e-8)
    assert regression.rmse(frame(spark, x, y), model).first()["rmse"] < 1e-8


@pytest.mark.parametrize("n", [2, 8, 20])
def test_any_number_of_features(spark, n):
    betas = [float(i) for i in range(1, n + 1)]
    df = generate_linear(spark, 300, betas, alpha=4.0)
    model = regression.fit_linear(df)
    assert len(model.features) == len(betas)
    assert np.allclose(model.coefficients, betas, atol=1e-6)
    assert abs(model.intercept - 4.0) < 1e-6


@pytest.mark.parametrize("copies", [2, 5, 6, 9])
def test_copies_share_a_weight_whatever_their_number(spark, copies):
    rng = np.random.default_rng(6)
    a = rng.normal(size=300)
    model = regression.fit_linear(frame(spark, np.column_stack([a] * copies), 6 * a + 1))
    assert np.allclose(model.coefficients, 6 / copies, atol=1e-9) and abs(model.intercept - 1) < 1e-9


def test_one_row(spark):
    model = regression.fit_linear(spark.createDataFrame([(3.0, 5.0)], "x_1 double, y double"))
    assert model.coefficients == (0.0,) and model.intercept == 5.0


def test_missing_values_and_empty_tables_are_refused(spark):
    df = spark.createDataFrame([(1.0, 1.0), (float("nan"), 2.0), (None, 3.0)], "x_1 double, y double")
    with pytest.raises(ValueError, match="2 rows"):
        regression.fit_linear(df)
    with pytest.raises(ValueError, match="empty"):
        regression.fit_linear(df.limit(0))
    with pytest.raises(ValueError, match="no feature"):
        regression.fit_linear(df.select("y"))


def test_features_are_chosen_by_prefix(spark):
    df = spark.createDataFrame([], "id int, x_2 double, y double, x_1 double, ax_3 double")
    assert regression.feature_columns(df) == ["x_2", "x_1"]


def test_prediction(spark):
    model = regression.LinearModel(("x_1",), (2.0,), 1.0, 3)
    df = spark.createDataFrame([(1.5,)], "x_1 double")
    assert regression.predict(df, model).first()["prediction"] == 4.0
    assert tuple(model.as_frame(spark).first()) == (["x_1"], [2.0], 1.0, 3)
    assert [tuple(row) for row in model.terms(spark).collect()] == [("x_1", 2.0), ("intercept", 1.0)]


@pytest.mark.parametrize("zone", [None, dt.timezone.utc])
def test_registry_row(spark, zone):
    model = regression.LinearModel(("x_1", "x_2"), (2.0, 3.0), 1.0, 3)
    errors = spark.range(1).select(F.lit(0.5).alias("rmse"))
    row = regression.registry_row(errors, model, "./m/", dt.datetime(2026, 1, 2, 3, 4, 5, 6, zone))
    assert tuple(row.first()) == ("./m/linear_model_20260102_030405.parquet", 0.5, '["x_1","x_2"]')
