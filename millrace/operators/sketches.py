"""Quantiles and distinct values of tables that grow, from stored sketches that merge."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.missing import column, is_missing, present

# Size of a quantile sketch. Up to as many values its ranks are exact; beyond, they are off by
# less than RANK_ERROR of the values, in 99 of 100 cases.
QUANTILE_SIZE = 4096
RANK_ERROR = 0.002
# Parts that the ranks of a sketch are told in.
RANK_STEPS = 2000
# Base-2 logarithm of the buckets of a distinct sketch, whose counts are off by less than
# DISTINCT_ERROR, in 99 of 100 cases.
DISTINCT_BITS = 14
DISTINCT_ERROR = 0.02
# Distinct values up to which they are listed.
LISTED = 100


def quantile_sketches(df: DataFrame, period: Column, key: str, value: str,
                      size: int = QUANTILE_SIZE) -> DataFrame:
    """(period, key, n_rows, n_values, sketch): one pass, and one row for each task, period and
    key in the shuffle. NULL and NaN values count as rows only; NULL keys are a group."""
    v = present(df, value).cast("double")
    return df.groupBy(period.alias("period"), column(key).alias("key")).agg(
        F.count("*").alias("n_rows"), F.count(v).alias("n_values"),
        F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"))


def merged_quantiles(stored: DataFrame) -> DataFrame:
    """Sketches of the same period and key, from several runs, as one."""
    return stored.groupBy("period", "key").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def _ranks(sketch: Column, edges: Column) -> Column:
    """The share of values up to each edge, rounded down to ``RANK_STEPS`` parts of all.

    Spark tells the ranks of constants only. Edges differ by key, so they are looked up among
    the quantiles at all steps.
    """
    steps = F.lit(np.arange(1, RANK_STEPS + 1) / RANK_STEPS)
    found = F.struct(F.kll_sketch_get_quantile_double(sketch, steps).alias("steps"), edges.alias("edges"))
    return F.get(F.transform(F.array(found), lambda f: F.transform(f["edges"], lambda edge: F.size(
        F.filter(f["steps"], lambda step: step <= edge)) / F.lit(float(RANK_STEPS)))), 0)


def quantile_stability(sketches: DataFrame, bins: int = 10, reference: Column | None = None,
                       floor: float = 1e-4) -> DataFrame:
    """Per period and key the population stability index against the reference period of the
    key, by default its first: period, key, n_values, edges, shares, psi.

    The bins are the reference's own quantiles, taken from its sketch, so nobody has to know
    the range of the values, and the table is not read again. Shares are off by the error of
    the sketch and by one part of ``RANK_STEPS``. A bin is above its lower edge
    and up to its upper one; a share of nothing counts as ``floor``. Groups without a value,
    and those whose reference has none, have no index.
    """
    cuts = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    filled = F.when(F.col("n_values") > 0, F.col("sketch"))
    periods = Window.partitionBy("key")
    if reference is None:
        base = F.min_by("sketch", "period").over(periods)
        enough = F.min_by("n_values", "period").over(periods) > 0
    else:
        base = F.max(F.when(F.col("period") == reference, F.col("sketch"))).over(periods)
        enough = F.max(F.when(F.col("period") == reference, F.col("n_values"))).over(periods) > 0
    based = sketches.select("period", "key", "n_values", filled.alias("sketch"), F.when(enough, base).alias("base"))
    edged = based.withColumn("edges", F.kll_sketch_get_quantile_double("base", cuts))
    for name, sketch in (("shares", "sketch"), ("base_shares", "base")):
        ranks = _ranks(F.col(sketch), F.col("edges"))
        upper, lower = F.concat(ranks, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), ranks)
        edged = edged.withColumn(name, F.zip_with(upper, lower, lambda a, b: a - b))
    parts = F.zip_with("shares", "base_shares", lambda p, q: (
        (F.greatest(p, F.lit(floor)) - F.greatest(q, F.lit(floor)))
        * F.ln(F.greatest(p, F.lit(floor)) / F.greatest(q, F.lit(floor)))))
    known = F.col("sketch").isNotNull() & F.col("base").isNotNull()
    psi = F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)
    return edged.select("period", "key", "n_values", "edges", F.when(known, F.col("shares")).alias("shares"),
                        F.when(known, psi).alias("psi"))


def distinct_sketches(df: DataFrame, names: Sequence[str] | None = None, listed: int = LISTED,
                      bits: int = DISTINCT_BITS) -> DataFrame:
    """One row per column: column_name, n_rows, n_missing, sketch, values.

    ``values`` has all distinct values, as sorted text, if they are at most ``listed``, and is
    NULL if they are more. One pass makes the sketches; a second one, over the columns whose
    sketch promises few values, lists them. Missing values are in neither.
    """
    names = list(df.columns if names is None else names)
    texts = [F.when(~test, column(name).cast("string")) for name, test in zip(names, is_missing(df, names))]
    counted = df.agg(F.count("*").alias("n_rows"), *[F.count(t).alias(f"n{i}") for i, t in enumerate(texts)],
                     *[F.hll_sketch_agg(t, F.lit(bits)).alias(f"s{i}") for i, t in enumerate(texts)])
    row = counted.select("*", *[F.hll_sketch_estimate(f"s{i}").alias(f"e{i}") for i in range(len(names))]).first()
    short = [i for i in range(len(names)) if row[f"e{i}"] <= listed * (1 + 2 * DISTINCT_ERROR) + 1]
    spark = df.sparkSession
    sketches = spark.createDataFrame(
        [(name, row["n_rows"], row["n_rows"] - row[f"n{i}"], row[f"s{i}"]) for i, name in enumerate(names)],
        "column_name string, n_rows bigint, n_missing bigint, sketch binary").coalesce(1)
    entries = F.array(*[F.struct(F.lit(names[i]).alias("name"), texts[i].alias("value")) for i in short])
    lists = (df.select(F.explode(entries).alias("e")).select("e.*").where("value IS NOT NULL").distinct()
             if short else spark.createDataFrame([], "name string, value string"))
    lists = lists.groupBy("name").agg(F.array_sort(F.collect_list("value")).alias("found"))
    few = F.coalesce("found", F.array().cast("array<string>"))
    known = F.col("column_name").isin([names[i] for i in short]) & (F.size(few) <= listed)
    return (sketches.join(lists, F.col("column_name") == F.col("name"), "left")
            .select("column_name", "n_rows", "n_missing", "sketch", F.when(known, few).alias("values")))


def merged_distincts(stored: DataFrame, listed: int = LISTED) -> DataFrame:
    """The rows of several runs as one per column, with the estimated count: column_name,
    n_rows, n_missing, n_distinct, values, sketch. Values are listed if all runs listed theirs
    and they are few enough together, and are then counted and not estimated."""
    union = stored.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"),
        F.hll_union_agg("sketch").alias("sketch"), F.bool_and(F.col("values").isNotNull()).alias("all"),
        # As long as the runs are many: each list is bounded, and they overlap.
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("values")))).alias("found"))
    values = F.when(F.col("all") & (F.size("found") <= listed), F.col("found"))
    return union.withColumn("values", values).select(
        "column_name", "n_rows", "n_missing",
        F.coalesce(F.size("values").cast("bigint"), F.hll_sketch_estimate("sketch")).alias("n_distinct"),
        "values", "sketch")
