"""Every registered query against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

from millrace.queries import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(TABLES):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{file}'")
    return connection


def comparable(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else repr(float(value) + 0.0)
    return str(value)


def table(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(comparable(row[i]) for i in order) for row in values)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    expected = duck.execute(SQL[name])
    names = [column[0] for column in expected.description]
    assert table(df.columns, df.collect()) == table(names, expected.fetchall())
