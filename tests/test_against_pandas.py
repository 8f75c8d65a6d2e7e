"""The same steps in pandas on random tables with NaN, NULL and copies."""

import numpy as np
import pandas as pd
import pytest

from millrace.operators import cleaning, quality, regression


@pytest.fixture(params=range(4))
def pair(spark, request):
    rng = np.random.default_rng(request.param)
    n = 400
    frame = pd.DataFrame({"x_1": rng.integers(0, 4, n).astype(float),
                          "x_2": rng.integers(0, 6, n) / 4, "y": rng.integers(0, 3, n) * 1.5})
    for name in frame:
        frame.loc[rng.random(n) < 0.1, name] = np.nan
    frame = pd.concat([frame, frame.sample(40, replace=True, random_state=request.param),
                       pd.DataFrame(np.nan, index=range(5), columns=frame.columns)],
                      ignore_index=True)
    # Half of the missing values reach Spark as NULL, the others as NaN.
    data = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in row)
            for i, row in enumerate(frame.itertuples(index=False))]
    return frame, spark.createDataFrame(data, "x_1 double, x_2 double, y double")


def test_null_counts(pair):
    frame, df = pair
    counts = quality.null_counts(df).first().asDict()
    assert {name: counts[name] for name in frame} == frame.isna().sum().to_dict()
    assert counts["total_nulls"] == frame.isna().sum().sum() and counts["total_rows"] == len(frame)
    assert cleaning.null_rows(df).first()["null_rows"] == frame.isnull().any(axis=1).sum()


def test_cleaning(pair):
    frame, df = pair
    expected = frame.drop_duplicates().dropna()
    assert sorted(map(tuple, cleaning.clean(df).collect())) == sorted(
        expected.itertuples(index=False, name=None))
    report = cleaning.cleaning_report(df).first()
    assert (report["rows_before"], report["rows_after"]) == (len(frame), len(expected))
    assert report["dropped_rows"] == len(frame) - len(expected)


def test_fit(pair):
    frame, df = pair
    clean = frame.drop_duplicates().dropna()
    x = np.column_stack([clean[["x_1", "x_2"]], np.ones(len(clean))])
    solution = np.linalg.lstsq(x, clean["y"], rcond=None)[0]
    table = cleaning.clean(df)
    model = regression.fit_linear(table)
    assert np.allclose([*model.coefficients, model.intercept], solution)
    error = np.sqrt(np.mean((clean["y"] - x @ solution) ** 2))
    assert np.isclose(regression.rmse(table, model).first()["rmse"], error)
