"""Known-answer data: uniform features with an exactly linear target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.contracts import ALPHA, BETAS, COPIED_ROWS, NULL_ROWS, TARGET, feature_names
from millrace.functions.missing import column
from millrace.functions.numbers import linear, uniforms
from millrace.operators.sampling import sample_rows

ROW_KEY = "row_key"


def linear_rows(keys: DataFrame, key: str, betas: Sequence[float] = BETAS,
                alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """One row per key: the key, features ``x_1..x_n`` and the target.

    The numbers are a function of the key, so the row count and its partitioning are
    those of ``keys`` and a lost task is recomputed to the same rows. They come out of a
    generator, which keeps later filters from computing them again.
    """
    names = feature_names(len(betas))
    values = uniforms(column(key), len(betas), seed)
    numbers = F.struct(*[value.alias(name) for value, name in zip(values, names)])
    rows = keys.select(column(key).alias(ROW_KEY), F.inline(F.array(numbers)))
    return rows.withColumn(TARGET, linear([F.col(name) for name in names], betas, alpha))


def generate_linear(spark: SparkSession, rows: int, betas: Sequence[float] = BETAS,
                    alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """The same, keyed by the numbers from 0 to ``rows`` - 1."""
    return linear_rows(spark.range(rows), "id", betas, alpha, seed)


def pollute(df: DataFrame, key: str, null_rows: int = NULL_ROWS, copies: int = COPIED_ROWS,
            seed: int = 0) -> DataFrame:
    """Append all-null rows, then copies of randomly drawn rows; the key is dropped.

    ``key`` is a non-negative whole number and unique. The null rows get negative
    keys, so that they too can be drawn.
    """
    blanks = df.sparkSession.range(null_rows).select(
        (-1 - F.col("id")).cast(df.schema[key].dataType).alias(key))
    extended = df.unionByName(blanks, allowMissingColumns=True)
    drawn = sample_rows(extended, key, copies, seed).select(*df.columns)
    return extended.unionByName(drawn).drop(key)
