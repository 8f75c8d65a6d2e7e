"""Contract and null checks as report frames, and gates that act on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce, wraps
from operator import add

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.contracts import Contract, in_family
from millrace.functions.missing import column, is_missing

EMPTY = "the table is empty"


class CheckFailed(Exception):
    """A blocking check did not pass; ``report`` is its report row."""

    def __init__(self, name: str, report: dict):
        super().__init__(f"{name}: {report}")
        self.report = report


class ContractBroken(TypeError):
    """A step returned something else than it declares."""


def null_counts(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """One row: missing values per column, their total, and the row count; 0 when empty."""
    names = list(df.columns if names is None else names)
    counts = [F.count_if(test).alias(name) for test, name in zip(is_missing(df, names), names)]
    total = reduce(add, [column(name) for name in names], F.lit(0)).cast("bigint")
    # One aggregation for all columns; "*" keeps the counts and total_rows.
    return (df.agg(*counts, F.count("*").alias("total_rows"))
              .select("*", total.alias("total_nulls")))


def null_counts_by_column(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The same counts with one row per column."""
    names = list(df.columns if names is None else names)
    entry = [F.struct(F.lit(name).alias("column_name"), column(name).alias("null_count"))
             for name in names]
    return (null_counts(df, names).select(F.explode(F.array(*entry)).alias("c"), "total_rows")
            .select("c.*", "total_rows"))


def null_check(df: DataFrame, names: Iterable[str], fail_on_empty: bool = True) -> DataFrame:
    """One row: did the required columns hold no missing value?

    An unknown column is an error, not a failed check. An empty table fails with a
    reason, or passes when ``fail_on_empty`` is off.
    """
    names = list(names)
    empty = F.col("total_rows") == 0
    passed = F.col("total_nulls") == 0
    reason = F.lit(None).cast("string")
    if fail_on_empty:
        passed, reason = passed & ~empty, F.when(empty, EMPTY)
    by_column = F.map_from_arrays(F.array(*[F.lit(name) for name in names]),
                                  F.array(*[column(name) for name in names]))
    return null_counts(df, names).select(
        passed.alias("passed"), reason.alias("reason"), "total_rows", "total_nulls",
        by_column.alias("nulls_by_column"),
        F.array(*[F.lit(name) for name in names]).alias("columns_checked"))


def compare_schema(schema: T.StructType, contract: Contract) -> list[tuple[str, str, str, str]]:
    """(column, expected family, observed type, status) for expected and extra columns."""
    observed = {field.name: field.dataType for field in schema}
    rows = []
    for name, rule in contract.items():
        if name not in observed:
            rows.append((name, rule.family, None, "missing"))
        else:
            good = in_family(observed[name], rule.family)
            rows.append((name, rule.family, observed[name].simpleString(),
                         "ok" if good else "wrong_type"))
    rows += [(name, None, data_type.simpleString(), "extra")
             for name, data_type in observed.items() if name not in contract]
    return rows


def schema_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per column with its status, and whether the whole contract holds.

    Extra columns are allowed; an empty table fails. The comparison needs the schema
    only; the row count of a Parquet table comes from its file footers.
    """
    rows = compare_schema(df.schema, contract)
    good = all(status in ("ok", "extra") for *_, status in rows)
    entries = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit(family).cast("string").alias("expected"),
                 F.lit(kind).cast("string").alias("observed"), F.lit(status).alias("status"))
        for name, family, kind, status in rows])
    not_empty = F.col("total_rows") > 0
    return (df.agg(F.count("*").alias("total_rows"))
              .select(F.explode(entries).alias("c"), "total_rows",
                      (F.lit(good) & not_empty).alias("passed"),
                      F.when(~not_empty, EMPTY).alias("reason"))
              .select("c.*", "total_rows", "passed", "reason"))


def require_types(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` itself, or CheckFailed for a missing column or a wrong type; reads no row."""
    rows = compare_schema(df.schema, contract)
    report = {
        "missing_columns": [name for name, _, _, status in rows if status == "missing"],
        "wrong_type_columns": {name: kind for name, _, kind, status in rows
                               if status == "wrong_type"},
        "observed_types": {f.name: f.dataType.simpleString() for f in df.schema},
    }
    if report["missing_columns"] or report["wrong_type_columns"]:
        raise CheckFailed("schema", report)
    return df


def require_schema(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` itself, or CheckFailed before anything downstream is even planned."""
    if require_types(df, contract).isEmpty():
        raise CheckFailed("schema", {"reason": EMPTY})
    return df


def null_report(rows: int, nulls: Mapping[str, int], fail_on_empty: bool = True) -> dict:
    """The row of ``null_check`` from counts that are known already."""
    empty, total = rows == 0, sum(nulls.values())
    return {"passed": total == 0 and not (empty and fail_on_empty),
            "reason": EMPTY if empty and fail_on_empty else None, "total_rows": rows,
            "total_nulls": total, "nulls_by_column": dict(nulls), "columns_checked": list(nulls)}


def require_counts(rows: int, nulls: Mapping[str, int], fail_on_empty: bool = True) -> dict:
    """The report of counts that pass the null check, else CheckFailed."""
    report = null_report(rows, nulls, fail_on_empty)
    if not report["passed"]:
        raise CheckFailed("null check", report)
    return report


def require(df: DataFrame, report: DataFrame, name: str = "check") -> DataFrame:
    """Blocking gate: run the one-row check now, and return ``df`` only if it passed."""
    outcome = report.first()
    if outcome is None or not outcome["passed"]:
        raise CheckFailed(name, outcome.asDict() if outcome else {"reason": "no report"})
    return df


def gate(df: DataFrame, report: DataFrame) -> DataFrame:
    """The same gate inside one plan: all rows of ``df`` if the check passed, else none.

    The check is a scalar subquery, so Spark runs it first and once, and the rows
    themselves need no join. A closed gate still reads the table; use ``require`` where
    it should cost nothing.
    """
    return df.where(F.coalesce(report.select("passed").scalar(), F.lit(False)))


def conforms(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``df`` if its column names and types are the declared ones, else ContractBroken.

    Nullability is not compared: Parquet does not keep it, the null checks cover it.
    """
    if not isinstance(df, DataFrame):
        raise ContractBroken(f"expected a DataFrame, got {type(df).__name__}")
    found = [(f.name, f.dataType) for f in df.schema]
    wanted = [(f.name, f.dataType) for f in declared]
    if found != wanted:
        raise ContractBroken(f"expected {declared.simpleString()}, got {df.schema.simpleString()}")
    return df


def returns(declared: T.StructType | None) -> Callable:
    """Decorator that enforces what a step declares to return; ``None``: nothing."""
    def wrap(step: Callable) -> Callable:
        @wraps(step)
        def checked(*args, **kwargs):
            result = step(*args, **kwargs)
            if declared is not None:
                return conforms(result, declared)
            if result is not None:
                raise ContractBroken(f"{step.__name__} declares no result, "
                                     f"got {type(result).__name__}")
        return checked
    return wrap
