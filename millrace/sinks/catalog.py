"""Catalog tables: create if absent, append with generated keys, insert one row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.contracts import TABLES, TableColumn
from millrace.sinks.files import staged


def column_list(columns: tuple[TableColumn, ...]) -> str:
    return ", ".join(
        f"`{c.name}` {c.sql_type}" + (" NOT NULL" if c.required else "")
        + (" DEFAULT localtimestamp()" if c.name == "inserted_at" else "")
        for c in columns)


# Table property that holds the first key not yet given away.
NEXT_ID = "millrace.next_id"


def create_table(spark: SparkSession, name: str, columns: tuple[TableColumn, ...] | None = None,
                 location: str | None = None) -> None:
    """Create the table unless it is there. Known names need no column list."""
    columns = TABLES[name.split(".")[-1]] if columns is None else columns
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({column_list(columns)}) USING parquet"
              + where, args={"name": name})


def reserve_ids(spark: SparkSession, name: str, n: int) -> int:
    """The first of ``n`` keys that nobody else gets, from a property of the table.

    A failed append leaves a gap, never a key given twice. Tables that were filled without
    the property are searched for their greatest key, once. One writer at a time.
    """
    found = {row["key"]: row["value"] for row in spark.sql(
        "SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name}).collect()}
    if NEXT_ID in found:
        first = int(found[NEXT_ID])
    else:
        top = spark.table(name).agg(F.max("id")).first()[0]
        first = 0 if top is None else top + 1
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ('{NEXT_ID}' = '{first + n}')",
              args={"name": name})
    return first


def numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows with a dense ``position`` from 0 up, and how many they are.

    Rows are staged with their task and their place in it; the tasks' counts, a row for each
    task, are added up. Nothing else is shuffled.
    """
    at = F.monotonically_increasing_id()
    placed = staged(df.withColumn("__at", at), "numbered")
    task, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = staged(placed.groupBy(task.alias("__task")).agg(F.count("*").alias("n")), "counts")
    before = (F.sum("n").over(Window.partitionBy().orderBy("__task")) - F.col("n")).alias("__before")
    total = counts.agg(F.sum("n")).first()[0] or 0
    out = (placed.withColumn("__task", task).join(counts.select("__task", before), "__task")
           .withColumn("position", F.col("__before") + place))
    return out.select(*df.columns, "position"), total


def append_rows(df: DataFrame, name: str) -> None:
    """Append with generated keys, dense and ascending, and one insert time."""
    spark = df.sparkSession
    rows, total = numbered(df)
    first = reserve_ids(spark, name, total)
    complete = (rows.withColumn("id", F.col("position") + first)
                .withColumn("inserted_at", F.localtimestamp()))
    complete.select(*spark.table(name).columns).write.mode("append").insertInto(name)


def insert_row(spark: SparkSession, name: str, values: Mapping[str, object]) -> None:
    """Insert one row by parameters, never by text; ``inserted_at`` takes its default."""
    row = {"id": reserve_ids(spark, name, 1), **values}
    columns = ", ".join(f"`{c}`" for c in row)
    markers = ", ".join(f":v{i}" for i in range(len(row)))
    spark.sql(f"INSERT INTO IDENTIFIER(:name) ({columns}) VALUES ({markers})",
              args={"name": name, **{f"v{i}": v for i, v in enumerate(row.values())}})
