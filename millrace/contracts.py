"""Schemas, column contracts and table definitions, kept as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, types and constants that callers and tables depend on.
# ---------------------------------------------------------------------------
PRICES_TABLE = "crypto_prices"
FEATURES_TABLE = "etl_table"
REGISTRY_TABLE = "model_registry"

MESSAGE_KEY = "coin"
MESSAGE_TIME = "timestamp"
EVENT_TIME = "event_timestamp"
COINS = ("bitcoin", "ethereum", "solana", "cardano", "polkadot")
CURRENCIES = ("usd", "eur")

MESSAGE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
MODEL_FOLDER = "./saved_models"
MODEL_NAME = "linear_model_"
MODEL_STAMP_FORMAT = "yyyyMMdd_HHmmss"

FEATURE_PREFIX = "x_"
TARGET = "y"
BETAS = (10.0, 100.0, 1000.0, 0.5)
ALPHA = 2.2
NULL_ROWS = 5
COPIED_ROWS = 3

# Models are stored as tables of one row, so the ending is this library's own.
MODEL_SUFFIX = ".parquet"

TYPE_FAMILIES: dict[str, tuple[type[T.DataType], ...]] = {
    "float": (T.FloatType, T.DoubleType),
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "string": (T.StringType,),
}
# ---------------------------------------------------------------------------

PRICE_MESSAGE = T.StructType([
    T.StructField(MESSAGE_KEY, T.StringType()),
    *[T.StructField(currency, T.DoubleType()) for currency in CURRENCIES],
    T.StructField(MESSAGE_TIME, T.StringType()),
])

PRICE_ROW = T.StructType([
    T.StructField(MESSAGE_KEY, T.StringType()),
    *[T.StructField(currency, T.DoubleType()) for currency in CURRENCIES],
    T.StructField(EVENT_TIME, T.TimestampNTZType()),
])

NESTED_PRICES = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))


def feature_names(n: int) -> list[str]:
    return [f"{FEATURE_PREFIX}{i}" for i in range(1, n + 1)]


@dataclass(frozen=True)
class Column:
    """What one column must look like: a type family, and whether nulls may occur."""

    family: str
    nullable: bool = False


Contract = dict[str, Column]

FEATURE_CONTRACT: Contract = {
    name: Column("float") for name in [*feature_names(len(BETAS)), TARGET]
}


# What cleaning declares to return: the feature table's own columns.
FEATURE_ROW = T.StructType([T.StructField(name, T.DoubleType()) for name in FEATURE_CONTRACT])


def contract_of(spec: Mapping[str, Mapping[str, object]]) -> Contract:
    """A contract from plain data, such as ``{"x_1": {"type": "float", "nullable": False}}``.

    Environments that differ keep one such mapping each.
    """
    for name, rule in spec.items():
        if rule["type"] not in TYPE_FAMILIES:
            raise ValueError(f"column {name}: unknown type family {rule['type']!r}")
    return {name: Column(rule["type"], bool(rule.get("nullable", False)))
            for name, rule in spec.items()}


def required_columns(contract: Contract) -> list[str]:
    """Columns in which a null is a failure."""
    return [name for name, column in contract.items() if not column.nullable]


def in_family(data_type: T.DataType, family: str) -> bool:
    """Families are strict: an integer column is not a float column."""
    return isinstance(data_type, TYPE_FAMILIES[family])


@dataclass(frozen=True)
class TableColumn:
    name: str
    sql_type: str
    required: bool = True


def _managed(*columns: TableColumn) -> tuple[TableColumn, ...]:
    """Every table has a generated key and an insert time around its own columns."""
    return (TableColumn("id", "BIGINT"), *columns, TableColumn("inserted_at", "TIMESTAMP_NTZ"))


TABLES: dict[str, tuple[TableColumn, ...]] = {
    PRICES_TABLE: _managed(
        TableColumn(MESSAGE_KEY, "VARCHAR(50)"),
        *[TableColumn(currency, "DOUBLE", required=False) for currency in CURRENCIES],
        TableColumn(EVENT_TIME, "TIMESTAMP_NTZ"),
    ),
    FEATURES_TABLE: _managed(*[TableColumn(name, "DOUBLE") for name in FEATURE_CONTRACT]),
    REGISTRY_TABLE: _managed(
        TableColumn("model_path", "STRING"),
        TableColumn("rmse", "DOUBLE"),
        TableColumn("features", "STRING"),
    ),
}
