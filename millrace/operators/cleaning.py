"""Duplicate and null removal, and what it removed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from millrace.functions.missing import any_missing, column, none_missing


def drop_missing(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Rows without a missing value in the named columns (all by default)."""
    return df.where(none_missing(df, names))


def drop_copies(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows; NULL equals NULL and NaN equals NaN.

    Each task drops its own copies before the shuffle, so a row copied very often
    costs one row per task there.
    """
    return df.dropDuplicates()


def clean(df: DataFrame) -> DataFrame:
    """Drop rows with a missing value, then copies; the order does not change the result."""
    return drop_copies(drop_missing(df))


def cleaning_report(df: DataFrame) -> DataFrame:
    """One row: rows before cleaning, distinct rows, rows after, rows dropped.

    One scan and one shuffle: equal rows are counted as one group with its size.
    """
    copies = "__copies"
    groups = df.groupBy(*[column(name) for name in df.columns]).agg(F.count("*").alias(copies))
    counts = groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count("*").alias("distinct_rows"),
        F.count_if(~any_missing(df)).alias("rows_after"),
    )
    return counts.withColumn("dropped_rows", F.col("rows_before") - F.col("rows_after"))


def null_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows have at least one missing value, and how many there are."""
    return df.agg(F.count_if(any_missing(df)).alias("null_rows"), F.count("*").alias("total_rows"))
