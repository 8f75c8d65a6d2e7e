"""Audits over finished tables: enrichment, reconciliation, drift, anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.missing import column, present
from millrace.sinks.files import staged


def enrich(df: DataFrame, dimension: DataFrame, on: Column | str, how: str = "inner") -> DataFrame:
    """Join with a table that has one row per key.

    No broadcast hint: Spark broadcasts a dimension that it measures to be small, and
    otherwise shuffles both sides and splits the partitions of frequent keys. ``df`` may
    be a stream.
    """
    return df.join(dimension, on, how)


def reconcile_counts(raw: DataFrame, clean: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on both sides, and how many are missing from the clean one.

    Both sides are counted in one aggregation. Unlike a join of two counts this shuffles
    once, and it also pairs NULL keys.
    """
    names = [column(key) for key in keys]
    both = (raw.select(*names, F.lit(1).alias("r"), F.lit(0).alias("c"))
            .unionByName(clean.select(*names, F.lit(0).alias("r"), F.lit(1).alias("c"))))
    return (both.groupBy(*names)
            .agg(F.sum("r").alias("raw_rows"), F.sum("c").alias("clean_rows"))
            .withColumn("missing_rows", F.col("raw_rows") - F.col("clean_rows")))


def content_sums(df: DataFrame, bucket: Column, names: Sequence[str]) -> DataFrame:
    """Per bucket the number of rows and the sum of their hashes, whatever their order."""
    hashed = F.xxhash64(*[column(name) for name in names]).cast("decimal(20,0)")
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n_rows"), F.sum(hashed).cast("decimal(38,0)").alias("content"))


def differing_buckets(left: DataFrame, right: DataFrame, key: str, buckets: int,
                      bucket: str | None = None) -> list[int]:
    """The numbers of the buckets whose contents differ, at most as many as there are."""
    sides = [content_sums(df, _bucket(key, buckets, bucket), left.columns)
             .select("bucket", *[(F.col(c) * sign).alias(c) for c in ("n_rows", "content")])
             for df, sign in ((left, 1), (right, -1))]
    sums = sides[0].unionByName(sides[1]).groupBy("bucket").agg(F.sum("n_rows").alias("n"), F.sum("content").alias("c"))
    return sorted(row["bucket"] for row in sums.where("n <> 0 OR c <> 0").collect())


def _bucket(key: str, buckets: int, bucket: str | None) -> Column:
    if bucket is not None:
        return column(bucket).cast("int")
    return F.pmod(F.xxhash64(column(key)), F.lit(buckets)).cast("int")


def reconcile_rows(left: DataFrame, right: DataFrame, key: str, buckets: int = 1024,
                   bucket: str | None = None) -> DataFrame:
    """The keys whose rows differ: key, status, left_only, right_only.

    The last two count the rows that have no equal on the other side. A key with such rows on
    the left is ``missing``, on the right ``extra``, on both sides ``changed``. Both sides have
    the same columns. First one pass over each side sums the hashes of the rows per bucket of
    keys, in any order; only rows of buckets that differ are compared, as hashes, by key. If
    both tables are stored by bucket, ``bucket`` is that column, and the second pass reads the
    files of those alone.

    Nothing is joined and no rows of a key are gathered: equal rows of a key are counted, so
    keys may occur several times, hot ones are added up by each task, and a NULL key is a key.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"different columns: {left.columns} and {right.columns}")
    names = [name for name in left.columns if name != bucket]
    wrong = differing_buckets(left.select(*map(column, left.columns)), right.select(*map(column, left.columns)),
                              key, buckets, bucket)
    rows = [df.where(_bucket(key, buckets, bucket).isin(wrong)).select(
        column(key).alias("__key"), F.xxhash64(*map(column, names)).alias("__hash"),
        F.lit(side).alias("__left"), F.lit(1 - side).alias("__right"))
        for df, side in ((left, 1), (right, 0))]
    alike = rows[0].unionByName(rows[1]).groupBy("__key", "__hash").agg(
        F.sum("__left").alias("__left"), F.sum("__right").alias("__right"))
    more = F.col("__left") - F.col("__right")
    keys = alike.where(more != 0).groupBy("__key").agg(
        F.sum(F.greatest(more, F.lit(0))).alias("left_only"), F.sum(F.greatest(-more, F.lit(0))).alias("right_only"))
    status = (F.when(F.col("right_only") == 0, "missing").when(F.col("left_only") == 0, "extra")
              .otherwise("changed"))
    return keys.select(F.col("__key").alias(key), status.alias("status"), "left_only", "right_only")


def enrich_as_of(df: DataFrame, dimension: DataFrame, key: str, time: str, valid_from: str,
                 columns: Sequence[str]) -> DataFrame:
    """Each row with the columns of its key's dimension row that was valid at its time.

    That is the one with the last ``valid_from`` not after the time; of several with the same
    one, the greatest by ``columns``. Rows before the first one, without a key or without a
    time keep their place with NULL columns. Dimension rows without a key or a time are not
    used.

    Both tables are dealt out together by ranges of key and time, so that a key with any
    number of rows, even at one time, is spread over several ranges. In each range a running
    last value per key is taken over the dimension's rows; the last value of a key in a range
    is handed on to its later ranges, of which only keys that reach over a border have any.
    """
    usable = column(key).isNotNull() & column(time).isNotNull()
    kept = [column(name) for name in df.columns]
    wanted = F.struct(*[column(name) for name in columns])
    shape = dimension.select(wanted.alias("d")).schema["d"].dataType
    facts = df.where(usable).select(
        column(key).alias("__key"), column(time).alias("__at"), F.lit(1).alias("__kind"),
        F.lit(None).cast(shape).alias("__dim"), F.struct(*kept).alias("__row"), F.xxhash64(*kept).alias("__tie"))
    known = dimension.where(column(key).isNotNull() & column(valid_from).isNotNull()).select(
        column(key).alias("__key"), column(valid_from).alias("__at"), F.lit(0).alias("__kind"),
        wanted.alias("__dim"), F.lit(0).cast("bigint").alias("__tie"))
    both = facts.unionByName(known, allowMissingColumns=True)
    ranges = staged(both.repartitionByRange("__key", "__at", "__kind", "__dim", "__tie")
                    .withColumn("__part", F.spark_partition_id()).drop("__tie"), "as-of")
    running = Window.partitionBy("__part", "__key").orderBy("__at", "__kind", "__dim")
    own = F.last("__dim", ignorenulls=True).over(running.rowsBetween(Window.unboundedPreceding, 0))
    ends = ranges.groupBy("__part", "__key").agg(
        F.max_by("__dim", F.when(F.col("__kind") == 0, F.struct("__at", "__dim"))).alias("__last"))
    earlier = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    handed = staged(ends.select("__part", "__key", F.last("__last", ignorenulls=True).over(earlier).alias("__handed"))
                    .where("__handed IS NOT NULL"), "as-of-handed")
    found = (ranges.withColumn("__own", own).where("__kind = 1").join(handed, ["__part", "__key"], "left")
             .withColumn("__found", F.coalesce("__own", "__handed")))
    result = found.select("__row.*", *[F.col("__found").getField(name).alias(name) for name in columns])
    rest = df.where(~usable).select(*kept, *[
        F.lit(None).cast(shape[name].dataType).alias(name) for name in columns])
    return result.unionByName(rest)


def _of_reference(stat: str, key: str, reference: Column | None) -> Column:
    """A statistic of the reference period, beside every period of its key.

    The window runs over aggregated rows, one per key and period, so it stays small
    however many rows a key has, and the table itself is read once.
    """
    periods = Window.partitionBy(key)
    if reference is None:
        return F.min_by(stat, "period").over(periods)
    return F.max(F.when(F.col("period") == reference, F.col(stat))).over(periods)


def drift_stats(df: DataFrame, period: Column, key: str, value: str,
                reference: Column | None = None) -> DataFrame:
    """Mean and spread per key and period beside those of the reference period.

    ``shift`` is the change of the mean in reference standard deviations. Without a
    reference, the first period of each key is the reference. NULL and NaN values count as
    rows and in nothing else; NULL keys are a group.
    """
    v = present(df, value)
    stats = df.groupBy(period.alias("period"), column(key)).agg(
        F.count("*").alias("n_rows"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("spread"))
    shift = (F.col("mean") - F.col("ref_mean")) / F.nullif(F.col("ref_spread"), F.lit(0.0))
    return (stats.withColumns({"ref_mean": _of_reference("mean", key, reference),
                               "ref_spread": _of_reference("spread", key, reference)})
            .withColumn("shift", shift))


def population_stability(df: DataFrame, period: Column, key: str, value: str,
                         edges: Sequence[float], reference: Column | None = None,
                         floor: float = 1e-4) -> DataFrame:
    """Population stability index per key and period over fixed bins.

    Bins are cut at the edges, the outer two are open. All bin counts of a group come
    from one aggregation; a share of nothing counts as ``floor``. NULL and NaN values are in
    no bin and not in ``n_rows``.
    """
    bounds = [None, *edges, None]
    v = present(df, value)

    def inside(low: float | None, high: float | None) -> Column:
        test = v.isNotNull()
        test = test if low is None else test & (v >= low)
        return test if high is None else test & (v < high)

    counts = [F.count_if(inside(low, high)) for low, high in zip(bounds, bounds[1:])]
    groups = (df.groupBy(period.alias("period"), column(key))
              .agg(F.array(*counts).alias("bins"), F.count(v).alias("n_rows")))
    shares = groups.withColumn(
        "shares", F.transform("bins", lambda n: F.greatest(F.try_divide(n, F.col("n_rows")), F.lit(floor))))
    paired = shares.withColumn("ref", _of_reference("shares", key, reference))
    parts = F.zip_with("shares", "ref", lambda p, q: (p - q) * F.ln(p / q))
    psi = F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)
    return paired.select("period", key, "n_rows", psi.alias("psi"))


def anomaly_flags(df: DataFrame, key: str, value: str, limit: float = 3.0) -> DataFrame:
    """Every row with its z-score within its key, flagged beyond ``limit``.

    The statistics are aggregated, staged and joined back. A window per key would sort
    all rows of a frequent key in one task; without staging, Spark would shuffle the
    table before it knew that a few rows of statistics can be broadcast. NULL keys are a
    group; a NULL or NaN value has no score and is no anomaly.
    """
    v = present(df, value)
    stats = staged(df.groupBy(column(key).alias("__key")).agg(
        F.avg(v).alias("__mean"), F.stddev_samp(v).alias("__spread")), "stats")
    z = (v - F.col("__mean")) / F.nullif(F.col("__spread"), F.lit(0.0))
    return (df.join(stats, column(key).eqNullSafe(F.col("__key")), "left").withColumn("z_score", z)
            .withColumn("is_anomaly", F.coalesce(F.abs(F.col("z_score")) > limit, F.lit(False)))
            .drop("__key", "__mean", "__spread"))
