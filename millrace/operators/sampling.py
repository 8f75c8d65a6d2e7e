"""Sampling an exact number of rows with replacement."""

from __future__ import annotations

from bisect import bisect_right
from hashlib import md5
from itertools import accumulate
from math import ceil, log2, sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.missing import column
from millrace.sinks.files import staged

DRAW = "draw"
# Rows of a bucket, about; a draw looks at the rows of one bucket.
BUCKET_ROWS = 256
# Draws and buckets up to which the driver places the draws; beyond, tables do.
FEW_DRAWS, FEW_BUCKETS = 1_000, 1 << 16


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the text's digest as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def _text(*parts: Column | str) -> Column:
    return F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def side_of(rows: int) -> int:
    """The buckets are a square of this side, a power of two."""
    return 1 << max(0, ceil(log2(sqrt(max(1.0, rows / BUCKET_ROWS)))))


def _cumulative(sizes: DataFrame, by: str, group: str | None) -> DataFrame:
    """Sorted (end, by, n) of each group's sizes, as one array."""
    window = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(by)
    ends = sizes.select(*([group] if group else []), F.struct(
        F.sum("n").over(window).alias("end"), F.col(by), F.col("n")).alias("part"))
    return (ends.groupBy(group) if group else ends.groupBy()).agg(
        F.array_sort(F.collect_list("part")).alias("parts"))


def _reached(parts: Column, position: Column) -> Column:
    """The first part that ends beyond the position."""
    return F.get(F.filter(parts, lambda part: part["end"] > position), 0)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows, drawn with replacement, with their draw number 0..n-1.

    ``key`` identifies a row. A draw's number gives a position among all rows. Rows lie in
    buckets by a digest of their key; the draw goes to the bucket that has its position, and
    takes the row there with the least digest of draw and key. So each row is equally likely,
    a rerun draws the same rows, and the first draws are those of a smaller sample. An empty
    input gives no rows. A NULL key is an error, and so is one that occurs twice and is drawn.

    The buckets are as many as the rows ask for. For few draws from a table of some million
    rows their sizes go to the driver, which places the draws. Otherwise sizes are added up in
    a square, one row of it and then one column, so that no task handles more than its side.
    Either way all rows give their keys, and only those of the buckets drawn are looked at.
    """
    if n < 0:
        raise ValueError("a sample cannot have a negative size")
    schema = df.limit(0).select(F.lit(0).alias(DRAW), "*")
    keys = df.select(column(key).alias("__key"))
    total = keys.agg(F.count("*").alias("rows"), F.count("__key").alias("keys")).first()
    if total["rows"] > total["keys"]:
        raise ValueError(f"{total['rows'] - total['keys']} rows have no {key}")
    if not total["rows"] or not n:
        return schema
    side = side_of(total["rows"])
    bucket = _number(_text(str(seed), F.col("__key")), 8) % (side * side)
    placed = keys.select("__key", bucket.alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    if n <= FEW_DRAWS and side * side <= FEW_BUCKETS:
        draws = _placed_here(sizes, n, seed, total["rows"])
        near = F.broadcast(df.sparkSession.createDataFrame(draws, f"{DRAW} int, bucket bigint"))
        # The buckets as constants, so that the keys of others go no further.
        placed = placed.where(F.col("bucket").isin(sorted({bucket for _, bucket in draws})))
        chosen = _chosen(placed, near, seed).collect()
        _refuse_repeated(max(row["times"] for row in chosen), key)
        wanted = df.where(column(key).isin(sorted({row["__key"] for row in chosen})))
        kept = F.broadcast(df.sparkSession.createDataFrame(
            [(row[DRAW], row["__key"]) for row in chosen], _types(df, key)))
    else:
        chosen = staged(_chosen(placed, staged(_placed(sizes, df, side, n, seed, total["rows"]), "sample-draws"),
                                seed), "sample-keys")
        _refuse_repeated(chosen.agg(F.max("times")).first()[0], key)
        wanted, kept = df, chosen.drop("times")
    return (wanted.join(kept, column(key) == F.col("__key"))
            .select(DRAW, *[column(c) for c in df.columns]))


def _types(df: DataFrame, key: str) -> str:
    return f"{DRAW} int, __key {df.select(column(key).alias('k')).schema['k'].dataType.simpleString()}"


def _placed_here(sizes: DataFrame, n: int, seed: int, rows: int) -> list[tuple[int, int]]:
    """The draws with the bucket of each, by the sizes of all buckets."""
    buckets = sorted((row["bucket"], row["n"]) for row in sizes.collect())
    ends = list(accumulate(count for _, count in buckets))
    positions = [int(md5(f"{seed}:{draw}:position".encode()).hexdigest()[:15], 16) % rows for draw in range(n)]
    return [(draw, buckets[bisect_right(ends, position)][0]) for draw, position in enumerate(positions)]


def _placed(sizes: DataFrame, df: DataFrame, side: int, n: int, seed: int, rows: int) -> DataFrame:
    """The same as tables, for any number of draws and buckets."""
    square = staged(sizes.select(F.floor(F.col("bucket") / side).alias("high"),
                                 (F.col("bucket") % side).alias("low"), "n"), "sample-buckets")
    tops = _cumulative(square.groupBy("high").agg(F.sum("n").alias("n")), "high", None)
    inside = _cumulative(square, "low", "high")
    position = _number(_text(str(seed), F.col(DRAW), "position"), 15) % rows
    return (df.sparkSession.range(n).select(F.col("id").cast("int").alias(DRAW))
            .withColumn("position", position).withColumn("tops", tops.scalar())
            .withColumn("top", _reached(F.col("tops"), F.col("position")))
            .select(DRAW, F.col("top.high").alias("high"),
                    (F.col("position") - F.col("top.end") + F.col("top.n")).alias("position"))
            .join(inside, "high")
            .select(DRAW, (F.col("high") * side + _reached(F.col("parts"), F.col("position"))["low"])
                    .alias("bucket")))


def _chosen(placed: DataFrame, draws: DataFrame, seed: int) -> DataFrame:
    """The key of each draw, and how often it occurs."""
    rank = F.struct(F.md5(_text(str(seed), F.col(DRAW), F.col("__key")).cast("binary")), "__key")
    return (placed.groupBy("__key", "bucket").agg(F.count("*").alias("times")).join(draws, "bucket")
            .groupBy(DRAW).agg(F.min_by("__key", rank).alias("__key"), F.min_by("times", rank).alias("times")))


def _refuse_repeated(times: int | None, key: str) -> None:
    if times and times > 1:
        raise ValueError(f"{key} does not identify a row")
