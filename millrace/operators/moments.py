"""Counts, means and centred products of columns, in one pass, mergeable over runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Row, functions as F

from millrace.functions.missing import any_missing, column, is_missing

# Columns up to which all products are aggregates of one pass; beyond, vectors are used.
NARROW = 24


@dataclass(frozen=True)
class Moments:
    """``products`` are sums over all rows of the products of two columns' distances from
    their means, ``nulls`` the missing values of each column, ``incomplete`` the rows that
    have one."""

    names: tuple[str, ...]
    rows: int
    incomplete: int
    nulls: tuple[int, ...]
    means: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(row: Row) -> Moments:
        k = len(row["names"])
        products = np.zeros((k, k))
        if row["n_rows"]:
            products[np.triu_indices(k)] = row["products"]
            products = np.triu(products) + np.triu(products, 1).T
        means = np.array(row["means"] if row["n_rows"] else [0.0] * k, float)
        return Moments(tuple(row["names"]), row["n_rows"], row["n_incomplete"], tuple(row["nulls"]),
                       means, products)


def _values(names: Sequence[str]) -> list[Column]:
    return [column(name).cast("double") for name in names]


def comoments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: names, n_rows, n_incomplete, nulls, means, products (the upper triangle, row by
    row).

    The table is read once. Spark adds up centred products and merges those of two tasks by
    the distance of their means, so nothing is lost to large means. NULL and NaN values are
    counted in ``nulls``; the other figures are of use only if there are none. Without rows,
    means and products are NULL.
    """
    names = list(names)
    if len(names) > NARROW:
        raise ValueError(f"{len(names)} columns; more than {NARROW} have no moments in one pass")
    values = _values(names)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[i:]]
    return df.agg(
        F.array(*[F.lit(name) for name in names]).alias("names"), F.count("*").alias("n_rows"),
        F.count_if(any_missing(df, names)).alias("n_incomplete"),
        F.array(*[F.count_if(test) for test in is_missing(df, names)]).alias("nulls"),
        F.array(*[F.avg(v) for v in values]).alias("means"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("covariances")).select(
        "names", "n_rows", "n_incomplete", "nulls", F.when(F.col("n_rows") > 0, F.col("means")).alias("means"),
        F.when(F.col("n_rows") > 0, F.transform("covariances", lambda c: c * F.col("n_rows"))).alias("products"))


def moments(df: DataFrame, names: Sequence[str]) -> Moments:
    """The moments of a table of any number of columns, on the driver.

    Up to ``NARROW`` columns they come from one pass. Wider tables are read three times: for
    counts, means and spreads, and for Spark's correlations, which adds products in blocks.
    """
    names = list(names)
    if len(names) <= NARROW:
        return Moments.of(comoments(df, names).first())
    values = _values(names)
    found = df.agg(
        F.count("*").alias("rows"), F.count_if(any_missing(df, names)).alias("incomplete"), F.array(*[F.count_if(t) for t in is_missing(df, names)]).alias("nulls"),
        F.array(*[F.avg(v) for v in values]).alias("means"),
        F.array(*[F.stddev_pop(v) for v in values]).alias("spreads")).first()
    counts = found["rows"], found["incomplete"], tuple(found["nulls"])
    if not found["rows"] or found["incomplete"]:
        return Moments(tuple(names), *counts, np.zeros(len(names)), np.zeros((len(names), len(names))))
    means, spread = np.array(found["means"]), np.array(found["spreads"])
    correlation = np.eye(len(names))
    if found["rows"] > 1:
        vectors = df.select(array_to_vector(F.array(*values)).alias("v"))
        correlation = Correlation.corr(vectors, "v").first()[0].toArray()
    # A column that never varies correlates with nothing.
    products = np.nan_to_num(correlation) * np.outer(spread, spread) * found["rows"]
    return Moments(tuple(names), *counts, means, products)


def merged(stored: DataFrame) -> DataFrame:
    """One row for all rows of ``comoments``, equal to that of all the tables together.

    Products are added up, and for each part its rows times the product of the distances of
    its means from the common ones. Parts of other columns are an error, parts without rows
    add nothing.
    """
    lists = [row["names"] for row in stored.select("names").distinct().limit(2).collect()]
    if len(lists) != 1:
        raise ValueError(f"moments of different columns: {lists}" if lists else "no moments")
    names, k = lists[0], len(lists[0])
    counts = [F.sum(F.get("nulls", i)).alias(f"nulls{i}") for i in range(k)]
    weighted = [F.sum(F.get("means", i) * F.col("n_rows")).alias(f"mean{i}") for i in range(k)]
    total = stored.agg(F.sum("n_rows").alias("n_rows"), *counts, *weighted).first()
    n = total["n_rows"]
    means = [total[f"mean{i}"] / n if n else 0.0 for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    products = [F.sum(F.get("products", at) + F.col("n_rows") * (F.get("means", i) - F.lit(means[i]))
                      * (F.get("means", j) - F.lit(means[j]))) for at, (i, j) in enumerate(pairs)]
    return stored.agg(
        F.array(*[F.lit(name) for name in names]).alias("names"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_incomplete").alias("n_incomplete"), F.array(*[F.lit(total[f"nulls{i}"]).cast("bigint") for i in range(k)]).alias("nulls"),
        F.array(*[F.lit(mean if n else None).cast("double") for mean in means]).alias("means"),
        F.array(*products).alias("products"))
