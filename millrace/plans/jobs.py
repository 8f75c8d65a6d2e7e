"""The flows end to end: clean and append, snapshot on change, check and train."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.contracts import (FEATURE_CONTRACT, FEATURE_ROW, FEATURES_TABLE, MODEL_FOLDER,
                                REGISTRY_TABLE, TABLES, TARGET, Contract, required_columns)
from millrace.operators.change import commit_cursor, current_counts, new_rows_since, read_cursors
from millrace.operators.cleaning import clean
from millrace.operators.profiling import distinct_values, head_json
from millrace.operators.moments import Moments, comoments, merged, moments
from millrace.operators.quality import (CheckFailed, conforms, null_check, require, require_counts,
                                        require_types, returns)
from millrace.operators.regression import (LinearModel, feature_columns, fit_moments, registry_row,
                                           rmse)
from millrace.sinks import catalog, slices
from millrace.sinks.files import RUN, append_run, read_runs, record_metrics, write_snapshot
from millrace.streaming import managed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class EtlReport:
    rows_before: int
    rows_after_cleaning: int
    dropped_rows: int


def run_slice(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return read_runs(spark, path).where(F.col(RUN) == run_id).drop(RUN)


def etl_job(raw: DataFrame, path: str, run_id: str, metrics: str | None = None,
            declared: T.StructType = FEATURE_ROW) -> EtlReport:
    """Clean a table and append it as one run; repeating the run replaces its rows.

    What is written has the ``declared`` columns; anything else is an error before a row is
    read.

    The counts come from the input and from the committed files, so that a task that
    had to run twice is not counted twice. The input is therefore read twice; stage it if
    it is no stored table and costly to compute. ``metrics`` is the table to report them to.
    """
    spark = raw.sparkSession
    append_run(conforms(clean(raw), declared), path, run_id)
    before, after = raw.count(), run_slice(spark, path, run_id).count()
    report = EtlReport(before, after, before - after)
    if metrics:
        record_metrics(spark, metrics, run_id, "clean",
                       {**asdict(report), "num_cols": len(raw.columns)})
    return report


@returns(None)
def etl_to_table(raw: DataFrame, name: str, declared: T.StructType = FEATURE_ROW) -> None:
    """Clean a table and append it to a catalog table, created if absent, whose key and
    insert time are filled in."""
    catalog.create_table(raw.sparkSession, name, TABLES[FEATURES_TABLE])
    catalog.append_rows(conforms(clean(raw), declared), name)


@returns(None)
def publish_checked(df: DataFrame, path: str, run_id: str, names: Sequence[str],
                    fail_on_empty: bool = False) -> None:
    """Append a table only if its required columns hold no missing value.

    A failed check raises, and neither the write nor anything after it happens.
    """
    append_run(require(df, null_check(df, names, fail_on_empty), "null check"), path, run_id)


def published(df: DataFrame, path: str, run_id: str, names: Sequence[str]) -> tuple[bool, int]:
    """Whether the check let the table through, and the rows that are there for the run."""
    try:
        publish_checked(df, path, run_id, names)
    except CheckFailed as failure:
        log.warning("nothing published: %s", failure)
        return False, 0
    return True, run_slice(df.sparkSession, path, run_id).count()


def published_once(df: DataFrame, path: str, run_id: str, names: Sequence[str]) -> tuple[bool, int]:
    """The same by one pass: written out of sight, audited there, and shown if all is well."""
    spark = df.sparkSession
    slices.create_slices(spark, path)
    try:
        slices.publish_observed(df, path, run_id, names)
    except CheckFailed as failure:
        log.warning("nothing published: %s", failure)
    seen = slices.visible(spark, path).where(F.col(slices.SLICE) == run_id).first()
    return seen is not None, seen["rows"] if seen else 0


@returns(None)
def moments_job(spark: SparkSession, features: str, moments_path: str, run_id: str,
                names: Sequence[str]) -> None:
    """Keep the moments of a run of the feature table; only the rows of that run are read."""
    append_run(comoments(run_slice(spark, features, run_id), names), moments_path, run_id)


def fit_runs(spark: SparkSession, moments_path: str, target: str = TARGET) -> LinearModel:
    """The fit over all runs whose moments are kept, without reading a row of them again."""
    return fit_moments(Moments.of(merged(read_runs(spark, moments_path)).first()), target=target)


def snapshot_job(spark: SparkSession, source: str, read: Callable[[], DataFrame],
                 cursors: str, folder: str, columns: Sequence[str],
                 metrics: str | None = None, head_by: Sequence[str] = (),
                 values_of: str | None = None) -> str | None:
    """If the source has more rows than its cursor, copy it whole; the path, else None.

    A source that cannot be counted is logged and left for the next poll. The cursor is
    committed after the copy, so that a failed copy is repeated, into the same path.
    ``metrics`` gets counts, the source, the first rows by ``head_by`` and the distinct values
    of a column.
    """
    try:
        table = read()
        state = new_rows_since(current_counts({source: table}), read_cursors(spark, cursors)).first()
    except Exception as error:  # whatever the source raises, the next poll tries again
        log.warning("cannot count %s: %s", source, error)
        return None
    if not state["fires"]:
        return None
    path = f"{folder.rstrip('/')}/{state['run_key']}"
    write_snapshot(table.select(*columns), path)
    commit_cursor(spark, cursors, source, state["new_cursor"], state["run_key"], path)
    if metrics:
        copy = spark.read.parquet(path)
        more = {"head": head_json(copy, head_by)} if head_by else {}
        if values_of:
            more["distinct_values"] = distinct_values(copy, values_of)
        record_metrics(spark, metrics, state["run_key"], "snapshot", {
            "row_count": copy.count(), "num_cols": len(columns), "source": source, **more})
    return path


def read_latest_snapshot(spark: SparkSession, source: str, cursors: str) -> DataFrame | None:
    row = read_cursors(spark, cursors).where(F.col("source") == source).first()
    return None if row is None else spark.read.parquet(row["snapshot"])


def snapshot_managed(spark: SparkSession, source: str, path: str, cursors: str) -> str | None:
    """If a managed table has more rows than its cursor, a snapshot of it; its name, else None.

    Nothing is copied and no row is read: the log knows how many there are, and a snapshot is
    the place in the log up to which it is read, as what is written stays as it is.
    """
    number, rows = managed.snapshot_state(spark, path)
    counts = spark.createDataFrame([(source, rows)], "source string, current_count bigint")
    state = new_rows_since(counts, read_cursors(spark, cursors)).first()
    if not state["fires"]:
        return None
    name = f"{path}@{number}"
    commit_cursor(spark, cursors, source, state["new_cursor"], state["run_key"], name)
    return name


def read_managed_snapshot(spark: SparkSession, source: str, cursors: str) -> DataFrame | None:
    row = read_cursors(spark, cursors).where(F.col("source") == source).first()
    if row is None:
        return None
    path, _, number = row["snapshot"].rpartition("@")
    return managed.read_managed(spark, path, int(number))


def training_job(table: DataFrame, registry: str, trained_at: datetime, *,
                 contract: Contract = FEATURE_CONTRACT, target: str = TARGET,
                 folder: str = MODEL_FOLDER, metrics: str | None = None,
                 table_name: str | None = None) -> LinearModel:
    """Check the table, fit, and record the model. Nothing is fitted if a check fails.

    The table is read twice, once for what is missing and for the moments of the fit, and once
    for the error, unless it is so wide that its moments take more.

    The model is written under ``folder``, to the path that the registry records;
    ``LinearModel.load`` reads it. ``metrics`` is the table to report the fit to, and
    ``table_name`` a registry in the catalog to insert the record into as well.
    """
    spark = table.sparkSession
    names = required_columns(contract)
    require_types(table, contract)
    features = feature_columns(table)
    found = moments(table, list(dict.fromkeys([*names, *features, target])))
    require_counts(found.rows, {name: found.nulls[found.names.index(name)] for name in names})
    model = fit_moments(found, features, target)
    error = rmse(table, model, target).first()["rmse"]
    run_id = trained_at.strftime("%Y%m%d_%H%M%S")
    errors = spark.createDataFrame([(error,)], "rmse double")
    record = registry_row(errors, model, folder, trained_at).first().asDict()
    # The model first: a path in the registry leads somewhere.
    model.save(spark, record["model_path"])
    append_run(spark.createDataFrame([record], "model_path string, rmse double, features string")
               .coalesce(1), registry, run_id)
    if table_name:
        catalog.create_table(spark, table_name, TABLES[REGISTRY_TABLE])
        catalog.insert_row(spark, table_name, record)
    if metrics:
        terms = dict(zip(model.features, model.coefficients))
        record_metrics(spark, metrics, run_id, "fit", {
            "num_training_rows": model.rows, "num_cols": len(table.columns), "rmse": error,
            "intercept": model.intercept,
            **{f"coefficient_{name}": value for name, value in terms.items()},
            "head": head_json(table, feature_columns(table))})
    return model
