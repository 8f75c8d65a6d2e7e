"""Table scans: Parquet folders, catalog tables, and JDBC in parallel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.missing import column


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[column(name) for name in columns])


def scan_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(table)
    return df if columns is None else df.select(*[column(name) for name in columns])


@dataclass(frozen=True)
class Split:
    """How a JDBC read is cut into parallel range queries on one indexed column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower),
                "upperBound": str(self.upper), "numPartitions": str(self.partitions)}


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options shared by reads and writes."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    options |= {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
    return options | dict(extra or {})


def scan_jdbc(spark: SparkSession, options: Mapping[str, str], split: Split | None,
              columns: Sequence[str] | None = None) -> DataFrame:
    """A database table; filters, projections and counts are done by the database.

    ``split=None`` has to be asked for: the whole table then comes through one connection,
    which suits small tables only.
    """
    every = {**options, **(split.options() if split else {}), "pushDownAggregate": "true"}
    df = spark.read.format("jdbc").options(**every).load()
    return df if columns is None else df.select(*[column(name) for name in columns])
