"""Row-level change capture applied to a table, or to the buckets of one that it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.missing import column
from millrace.sinks import slices
from millrace.sinks.files import staged

OPERATION = "op"
INSERT, UPDATE, DELETE = "I", "U", "D"


def _valid(key: str, operation: str) -> Column:
    known = F.coalesce(column(operation).isin(INSERT, UPDATE, DELETE), F.lit(False))
    return known & column(key).isNotNull()


def invalid_changes(changes: DataFrame, key: str, operation: str = OPERATION) -> DataFrame:
    """Changes that cannot be applied: without a key, or with an operation other than I, U, D."""
    return changes.where(~_valid(key, operation))


def latest_changes(changes: DataFrame, key: str, order: Sequence[str],
                   operation: str = OPERATION) -> DataFrame:
    """The last state of each key, without the keys whose last change is a delete.

    ``order`` is unique per key. The last change is an aggregate, not a window: each
    task keeps one change per key before the shuffle, however often a key changes.
    Invalid changes change nothing; ``invalid_changes`` has them.
    """
    last = F.max_by(F.struct(*[column(name) for name in changes.columns]),
                    F.struct(*[column(name) for name in order]))
    return (changes.where(_valid(key, operation)).groupBy(column(key).alias("__key"))
            .agg(last.alias("last"))
            .select("last.*").where(column(operation) != DELETE))


def apply_changes(base: DataFrame, changes: DataFrame, key: str, order: Sequence[str],
                  operation: str = OPERATION) -> DataFrame:
    """The table after the changes: untouched rows as they are, others in their last state.

    The changes are reduced to one per key and staged before they meet the table. If
    little is left, Spark broadcasts the keys and does not shuffle the table at all; if
    much is left, both sides are shuffled once by key, and no key has more than one change.
    Rows of the table without a key stay; invalid changes change nothing.
    """
    latest = staged(_last_states(base.columns, changes, key, order, operation), "changes")
    return _changed(base, latest, key)


def _last_states(row: Sequence[str], changes: DataFrame, key: str, order: Sequence[str],
                 operation: str) -> DataFrame:
    """The last change of each key, deletes among them, as ``__op`` and the columns of a row."""
    last = F.max_by(F.struct(*[column(name) for name in row], column(operation).alias("__op")),
                    F.struct(*[column(name) for name in order]))
    return (changes.where(_valid(key, operation)).groupBy(column(key).alias("__key"))
            .agg(last.alias("last")).select("last.*"))


def _changed(base: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    row = [column(name) for name in base.columns]
    upserts = latest.where(column("__op") != DELETE).select(*row)
    return base.join(latest.select(column(key)), key, "left_anti").select(*row).unionByName(upserts)


def bucket_of(df: DataFrame, key: str, buckets: int) -> Column:
    """The bucket of a row by its key; rows without a key are spread over all of them."""
    hashed = F.when(column(key).isNull(), F.xxhash64(*[column(c) for c in df.columns])).otherwise(
        F.xxhash64(column(key)))
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table as buckets by key, of which ``apply_to_buckets`` rewrites those that change.

    Choose so many that a bucket is some hundred megabytes.
    """
    slices.create_slices(df.sparkSession, path)
    attempt = slices.new_attempt()
    rows = slices.write_partitioned(df.withColumn(slices.SLICE, bucket_of(df, key, buckets)), path, attempt,
                                    slices.SLICE)
    slices.commit(df.sparkSession, path, attempt, {str(b): rows.get(str(b), 0) for b in range(buckets)})


def read_buckets(spark: SparkSession, path: str, schema: T.StructType,
                 buckets: Sequence[int] | None = None) -> DataFrame:
    """The table, or some of its buckets, with the bucket of each row as ``slice``."""
    return slices.read_slices(spark, path, schema, None if buckets is None else map(str, buckets))


def apply_to_buckets(spark: SparkSession, path: str, schema: T.StructType, changes: DataFrame,
                     key: str, order: Sequence[str], operation: str = OPERATION) -> list[int]:
    """Apply changes to a table of buckets; the buckets that were rewritten.

    The changes are reduced to one per key and staged; the buckets of what is left, a few
    numbers, say which files are read. These buckets alone are written anew, under other
    names, and take the place of the former ones by one commit. So a table is changed as a
    whole or not at all, applying the same changes again does no harm, and a bucket that
    nothing touches is neither read nor written. Its count is that of the first write.
    """
    buckets = slices.visible(spark, path).count()
    empty = spark.createDataFrame([], schema)
    typed = changes.withColumn(key, column(key).cast(schema[key].dataType))
    reduced = _last_states(schema.names, typed, key, order, operation)
    latest = staged(reduced.withColumn(slices.SLICE, bucket_of(empty, key, buckets)), "changes")
    touched = sorted(row[0] for row in latest.select(slices.SLICE).distinct().collect())
    if not touched:
        return []
    base = read_buckets(spark, path, schema, touched).withColumn(slices.SLICE, F.col(slices.SLICE).cast("int"))
    attempt = slices.new_attempt()
    rows = slices.write_partitioned(_changed(base, latest, key), path, attempt, slices.SLICE)
    slices.commit(spark, path, attempt, {str(b): rows.get(str(b), 0) for b in touched})
    return touched
