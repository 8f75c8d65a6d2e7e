"""Numeric expressions: keyed uniform numbers and weighted sums."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

HEX_DIGITS = 8
PER_DIGEST = 32 // HEX_DIGITS


def uniforms(key: Column, n: int, seed: int = 0) -> list[Column]:
    """``n`` numbers in [0, 1) that depend on the key and the seed alone.

    Unlike ``rand(seed)`` they do not depend on how the rows are partitioned, so a
    recomputed task gives the same rows again. One digest yields four numbers.
    """
    def digest(block: int) -> Column:
        return F.md5(F.concat(F.lit(f"{seed}:{block}:"), key.cast("string")).cast("binary"))

    def number(i: int) -> Column:
        start = (i % PER_DIGEST) * HEX_DIGITS + 1
        digits = F.substring(digest(i // PER_DIGEST), start, HEX_DIGITS)
        return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16 ** HEX_DIGITS))

    return [number(i) for i in range(n)]


def time_order(time: Column, tie: Column) -> Column:
    """Order by time, then by a whole number, as one value.

    Spark aggregates by hash with a decimal as the order of ``min_by``, but sorts all
    rows with a struct. Every time and every bigint has room in the 38 digits.
    """
    span = 2 * 10 ** 19  # wider than the range of a bigint
    micros = F.unix_micros(time.cast("timestamp")).cast("decimal(19,0)")
    return (micros * F.lit(str(span)).cast("decimal(20,0)") + tie.cast("decimal(19,0)")).cast("decimal(38,0)")


def linear(columns: Sequence[Column], weights: Sequence[float], constant: float) -> Column:
    """Weighted sum of the columns plus a constant, added from left to right."""
    if len(columns) != len(weights):
        raise ValueError(f"{len(columns)} columns but {len(weights)} weights")
    terms = [F.lit(float(weight)) * column for weight, column in zip(weights, columns)]
    return reduce(add, [*terms, F.lit(float(constant))])
