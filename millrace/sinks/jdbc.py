"""Database sinks. Spark commits a JDBC write per task, so a whole table goes through staging."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.contracts import TableColumn

Statements = Callable[[Sequence[str]], None]


def one_transaction(spark: SparkSession, options: Mapping[str, str]) -> Statements:
    """A runner that executes statements on the driver, all or none."""
    def run(statements: Sequence[str]) -> None:
        jvm = spark.sparkContext._jvm
        connection = jvm.java.sql.DriverManager.getConnection(
            options["url"], options.get("user"), options.get("password"))
        try:
            connection.setAutoCommit(False)
            for text in statements:
                statement = connection.createStatement()
                statement.execute(text)
                statement.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
    return run


# How the column types are called in databases.
DATABASE_TYPES = {"STRING": "TEXT", "DOUBLE": "DOUBLE PRECISION", "TIMESTAMP_NTZ": "TIMESTAMP"}


def create_statement(name: str, columns: Sequence[TableColumn]) -> str:
    """Create the table unless it is there; the database fills in key and insert time."""
    def definition(c: TableColumn) -> str:
        if c.name == "id":
            return '"id" BIGINT GENERATED BY DEFAULT AS IDENTITY PRIMARY KEY'
        return (f'"{c.name}" {DATABASE_TYPES.get(c.sql_type, c.sql_type)}'
                + (" DEFAULT CURRENT_TIMESTAMP" if c.name == "inserted_at" else "")
                + (" NOT NULL" if c.required else ""))
    return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(map(definition, columns))})"


def publish_statements(staging: str, target: str, columns: Sequence[str]) -> list[str]:
    """Move the staged rows; columns that are not named keep their defaults."""
    names = ", ".join(f'"{c}"' for c in columns)
    return [f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}",
            f"DELETE FROM {staging}"]


def append_table(df: DataFrame, options: Mapping[str, str], staging: str,
                 run: Statements | None = None, connections: int = 8,
                 batch_size: int = 5_000) -> None:
    """Append a table all or none: parallel tasks fill staging, one statement publishes it.

    Overwriting the staging table makes a retry start from nothing. ``connections``
    bounds what the database has to bear; the rows are dealt out for it, so that the work
    before is done by as many tasks as ever.
    """
    run = run or one_transaction(df.sparkSession, options)
    (df.repartition(connections).write.format("jdbc").mode("overwrite")
     .options(**{**options, "dbtable": staging, "truncate": "true",
                 "numPartitions": str(connections), "batchsize": str(batch_size)})
     .save())
    run(publish_statements(staging, options["dbtable"], df.columns))


def append_batches(df: DataFrame, options: Mapping[str, str], batch_size: int = 5_000) -> None:
    """Plain append, committed per task: a retry may duplicate rows."""
    df.write.format("jdbc").mode("append").options(**options, batchsize=str(batch_size)).save()
