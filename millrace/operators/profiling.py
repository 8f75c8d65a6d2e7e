"""What a step reports about its table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.missing import column


def profile(df: DataFrame, source: str) -> DataFrame:
    """One row: source, rows, columns."""
    return df.agg(F.count("*").alias("num_rows")).select(
        F.lit(source).alias("source"), "num_rows", F.lit(len(df.columns)).alias("num_cols"))


def head_rows(df: DataFrame, keys: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first rows in a defined order; each task keeps its own first ``n`` only."""
    return df.orderBy(*keys).limit(n)


def head_json(df: DataFrame, keys: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first rows as JSON texts, to be kept as metadata."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = F.to_json(F.struct("*"), {"timestampNTZFormat": micros, "timestampFormat": micros + "XXX"})
    return head_rows(df, keys, n).select(text.alias("head"))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """The values of a column, one per row, so that their number does not matter."""
    return df.select(column(name)).where(column(name).isNotNull()).distinct()
