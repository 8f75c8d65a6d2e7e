"""One notion of a missing value: NULL, and NaN in floating-point columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOATS = (T.FloatType, T.DoubleType)


def column(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _typed(df: DataFrame, names: Iterable[str] | None) -> list[tuple[Column, bool]]:
    # Selecting the columns makes an unknown one fail at once, with its name.
    names = df.columns if names is None else list(names)
    fields = df.select(*[column(name) for name in names]).schema
    return [(column(f.name), isinstance(f.dataType, FLOATS)) for f in fields]


def present(df: DataFrame, name: str) -> Column:
    """The column with NULL for NaN, as either means that the value is missing."""
    (value, floats), = _typed(df, [name])
    return F.nanvl(value, F.lit(None).cast("double")) if floats else value


def is_missing(df: DataFrame, names: Iterable[str] | None = None) -> list[Column]:
    """One test per column, in the order of the names."""
    return [value.isNull() | F.isnan(value) if floats else value.isNull()
            for value, floats in _typed(df, names)]


def any_missing(df: DataFrame, names: Iterable[str] | None = None) -> Column:
    return reduce(or_, is_missing(df, names), F.lit(False))


def none_missing(df: DataFrame, names: Iterable[str] | None = None) -> Column:
    """Conjunction with one plain null test per column, which Parquet can use."""
    tests = [test for value, floats in _typed(df, names)
             for test in ([value.isNotNull(), ~F.isnan(value)] if floats else [value.isNotNull()])]
    return reduce(and_, tests, F.lit(True))
