"""Ordinary least squares with an intercept, from means and centred products."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.contracts import (FEATURE_PREFIX, MODEL_NAME, MODEL_STAMP_FORMAT, MODEL_SUFFIX,
                                TARGET)
from millrace.functions.missing import column
from millrace.functions.numbers import linear
from millrace.operators.moments import Moments, moments

PREDICTION = "prediction"
# Share of a unit variance below which a direction counts as collinear.
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    rows: int

    def save(self, spark: SparkSession, path: str) -> None:
        self.as_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        row = spark.read.parquet(path).first()
        return LinearModel(tuple(row["features"]), tuple(row["coefficients"]), row["intercept"],
                           row["rows"])

    def as_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(list(self.features), list(self.coefficients), self.intercept, self.rows)],
            "features array<string>, coefficients array<double>, intercept double, rows bigint")

    def terms(self, spark: SparkSession) -> DataFrame:
        """One row per term of the equation."""
        return spark.createDataFrame(
            [*zip(self.features, self.coefficients), ("intercept", self.intercept)],
            "term string, coefficient double")


def feature_columns(df: DataFrame, prefix: str = FEATURE_PREFIX) -> list[str]:
    """Columns chosen by name prefix, in table order."""
    return [name for name in df.columns if name.startswith(prefix)]


def fit_linear(df: DataFrame, features: Sequence[str] | None = None,
               target: str = TARGET) -> LinearModel:
    """Least squares of the target on the features, however many there are.

    The table is read once, or three times if it is wide; what reaches the driver is a matrix
    of feature count squared. Collinear features get the least-norm solution. A missing value
    is an error, as is an empty table.
    """
    features = list(feature_columns(df) if features is None else features)
    if not features:
        raise ValueError("no feature columns")
    return fit_moments(moments(df, [*features, target]), features, target)


def fit_moments(found: Moments, features: Sequence[str] | None = None,
                target: str = TARGET) -> LinearModel:
    """The same from moments of the table, of all but the target unless features are named."""
    features = [name for name in found.names if name != target] if features is None else list(features)
    at = [found.names.index(name) for name in [*features, target]]
    _refuse(found.rows, found.incomplete if any(found.nulls[i] for i in at) else 0)
    return _solve(features, found.products[np.ix_(at, at)] / found.rows, found.means[at], found.rows)


def _solve(features: Sequence[str], covariance: np.ndarray, means: np.ndarray,
           rows: int) -> LinearModel:
    system, right = covariance[:-1, :-1], covariance[:-1, -1]
    # In units of one standard deviation the rank does not depend on the scale of a feature.
    scale = np.sqrt(np.where(np.diag(system) > 0, np.diag(system), 1.0))
    values, vectors = np.linalg.eigh(system / np.outer(scale, scale))
    kept = values > RANK_TOLERANCE * len(values)
    weights = (vectors[:, kept].T @ (right / scale)) / values[kept]
    slopes = vectors[:, kept] @ weights / scale
    # Directions without variance leave the fit as it is; choose the shortest solution.
    free = vectors[:, ~kept] / scale[:, None]
    if free.size:
        slopes = slopes - free @ np.linalg.lstsq(free, slopes, rcond=None)[0]
    return LinearModel(tuple(features), tuple(slopes.tolist()),
                       float(means[-1] - slopes @ means[:-1]), rows)


def _refuse(rows: int, missing: int) -> None:
    if rows == 0:
        raise ValueError("cannot fit a model on an empty table")
    if missing:
        raise ValueError(f"{missing} rows have a missing value")


def predict(df: DataFrame, model: LinearModel, name: str = PREDICTION) -> DataFrame:
    """Score every row with a plain expression; no model object travels to the tasks."""
    value = linear([column(f) for f in model.features], model.coefficients, model.intercept)
    return df.withColumn(name, value)


def rmse(df: DataFrame, model: LinearModel, target: str = TARGET) -> DataFrame:
    """One row: root of the mean squared residual, with divisor n."""
    residual = column(target) - F.col(PREDICTION)
    return predict(df, model).agg(F.sqrt(F.avg(residual * residual)).alias("rmse"))


def registry_row(errors: DataFrame, model: LinearModel, folder: str,
                 trained_at: datetime) -> DataFrame:
    """The registry record of a fit: artifact path, rmse, feature names as JSON."""
    text = trained_at.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
    stamp = F.date_format(F.lit(text).cast("timestamp_ntz"), MODEL_STAMP_FORMAT)
    return errors.select(
        F.concat(F.lit(f"{folder.rstrip('/')}/{MODEL_NAME}"), stamp, F.lit(MODEL_SUFFIX))
         .alias("model_path"),
        "rmse",
        F.to_json(F.array(*[F.lit(name) for name in model.features])).alias("features"))
