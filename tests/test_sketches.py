"""Stored sketches of quantiles and distinct values, and fields of messages."""

import math
import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from millrace.contracts import Column
from millrace.operators import fields, sketches
from millrace.sinks.files import append_run, read_runs

VALUES = "period int, k string, v double"


def sketched(spark, data, size=sketches.QUANTILE_SIZE):
    df = spark.createDataFrame(data, VALUES).repartition(5)
    return sketches.quantile_sketches(df, F.col("period"), "k", "v", size)


def index(p, q):
    return sum((max(a, 1e-4) - max(b, 1e-4)) * math.log(max(a, 1e-4) / max(b, 1e-4)) for a, b in zip(p, q))


def test_quantile_stability_by_hand(spark):
    data = [(1, "a", float(i)) for i in range(100)] + [(2, "a", float(i)) for i in range(50)]
    data += [(1, None, 1.0), (2, None, None), (2, "b", float("nan")), (3, "b", 2.0), (1, "c", 5.0), (3, "c", 5.0)]
    got = {(r["key"], r["period"]): r for r in sketches.quantile_stability(sketched(spark, data), 4).collect()}
    assert got["a", 1]["edges"] == [24.0, 49.0, 74.0] and got["a", 1]["psi"] == 0
    assert got["a", 2]["shares"] == [0.5, 0.5, 0.0, 0.0]
    assert math.isclose(got["a", 2]["psi"], index([0.5, 0.5, 0, 0], [0.25] * 4))
    assert got[None, 1]["psi"] == 0 and got[None, 2]["psi"] is None and got["b", 3]["psi"] is None
    assert got["c", 3]["psi"] == 0 and len(got) == 8
    fixed = sketches.quantile_stability(sketched(spark, data), 4, F.lit(3))
    assert {r["key"] for r in fixed.where("psi IS NOT NULL").collect()} == {"b", "c"}
    assert sketches.quantile_stability(sketched(spark, data[:0])).count() == 0


@pytest.mark.parametrize("size", [200, sketches.QUANTILE_SIZE])
def test_quantiles_within_the_stated_error(spark, folder, size):
    """A hot key and a rare one, over runs; larger groups than the sketch keeps whole."""
    rng = random.Random(size)
    data = [(k % 2, "hot" if rng.random() < 0.9 else "rare", rng.lognormvariate(k % 2, 1)) for k in range(60_000)]
    for run in range(3):
        append_run(sketched(spark, data[run::3], size), folder, f"r{run}")
    merged = sketches.merged_quantiles(read_runs(spark, folder))
    assert merged.count() == 4
    out = {(r["key"], r["period"]): r for r in sketches.quantile_stability(merged).collect()}
    allowed = sketches.RANK_ERROR if size == sketches.QUANTILE_SIZE else 0.03
    for key in ("hot", "rare"):
        exact = {p: sorted(v for q, k, v in data if k == key and q == p) for p in (0, 1)}
        edges = out[key, 0]["edges"]
        for i, edge in enumerate(edges):
            rank = sum(v <= edge for v in exact[0]) / len(exact[0])
            assert abs(rank - (i + 1) / 10) < allowed
        ranks = [sum(v <= e for v in exact[1]) / len(exact[1]) for e in edges]
        shares = [b - a for a, b in zip([0, *ranks], [*ranks, 1])]
        assert all(abs(a - b) < 2 * allowed + 2 / sketches.RANK_STEPS for a, b in zip(shares, out[key, 1]["shares"]))
        assert out[key, 1]["n_values"] == len(exact[1])


def test_sketches_are_one_pass_without_a_sort(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    made = sketches.quantile_sketches(df, F.to_date("ts"), "event_type", "value")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ObjectHashAggregate") == 2
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def distinct(spark, data, listed=5):
    df = spark.createDataFrame(data, "few string, many int, v double, none string").repartition(4)
    return sketches.distinct_sketches(df, listed=listed)


def test_distinct_values_over_runs(spark, folder):
    data = [("abc"[i % 3], i // 2, float(i % 7), None) for i in range(20_000)] + [(None, None, float("nan"), None)]
    for run in range(4):
        append_run(distinct(spark, data[run::4]), folder, f"r{run}")
    append_run(distinct(spark, []), folder, "nothing")
    stored = read_runs(spark, folder)
    assert stored.count() == 20
    merged = {r["column_name"]: r for r in sketches.merged_distincts(stored, 5).collect()}
    assert merged["few"]["values"] == ["a", "b", "c"] and merged["few"]["n_distinct"] == 3
    assert merged["few"]["n_missing"] == 1 and merged["v"]["n_missing"] == 1 and merged["none"]["n_missing"] == 20_001
    assert merged["none"]["values"] == [] and merged["none"]["n_distinct"] == 0
    assert merged["many"]["values"] is None and merged["v"]["values"] is None and merged["v"]["n_distinct"] == 7
    assert abs(merged["many"]["n_distinct"] - 10_000) <= 10_000 * sketches.DISTINCT_ERROR
    whole = {r["column_name"]: r for r in sketches.merged_distincts(distinct(spark, data), 5).collect()}
    for name, row in merged.items():
        assert (row["n_rows"], row["n_distinct"], row["values"]) == (
            whole[name]["n_rows"], whole[name]["n_distinct"], whole[name]["values"])


def test_lists_that_grow_too_long_together(spark):
    one, two = distinct(spark, [(c, 1, 1.0, "x") for c in "abcd"]), distinct(spark, [(c, 1, 1.0, "x") for c in "cdef"])
    assert {r["column_name"]: r["values"] for r in one.collect()}["few"] == list("abcd")
    merged = {r["column_name"]: r for r in sketches.merged_distincts(one.unionByName(two), 5).collect()}
    assert merged["few"]["values"] is None and merged["few"]["n_distinct"] == 6
    assert merged["none"]["values"] == ["x"]


CONTRACT = {"coin": Column("string"), "usd": Column("float"), "size": Column("int")}


def test_fields_of_messages(spark):
    texts = [(1, '{"coin":"a","usd":1,"size":2}'), (1, '{"coin":"b","usd":1.5,"more":{"x":[1]}}'),
             (2, '{"coin":1,"usd":"x"}'), (2, '{"coin":"b","usd":2}'), (2, '{"size":1.5}'), (2, '{"size":null}'),
             (3, "{}"), (3, "[1,2]"), (3, "#"), (3, None), (None, '{"coin":null}'), (4, '7')]
    df = spark.createDataFrame(texts, "h int, t string")
    got = {(r["period"], r["field"]): (r["expected"], r["observed"], r["n_messages"], r["status"])
           for r in fields.field_drift(fields.message_fields(df, "t", F.col("h")), CONTRACT).collect()}
    assert got[1, "coin"] == ("string", "string", 2, "ok") and got[1, "usd"] == ("float", "float", 2, "ok")
    assert got[1, "size"] == ("int", "int", 1, "ok") and got[1, "more"] == (None, "object", 1, "new")
    assert got[2, "coin"] == ("string", "mixed", 2, "retyped") and got[2, "usd"] == ("float", "mixed", 2, "retyped")
    assert got[2, "size"] == ("int", "float", 2, "retyped")
    for period in (3, 4):
        assert {got[period, name][3] for name in CONTRACT} == {"vanished"}
    assert got[None, "coin"] == ("string", "null", 1, "ok") and got[None, "usd"][3] == "vanished"
    assert len(got) == 16
    assert fields.field_drift(fields.message_fields(df.limit(0), "t", F.col("h")), CONTRACT).count() == 0


def test_messages_are_read_once_and_counted_before_the_shuffle(spark):
    df = spark.createDataFrame([(k % 3, b'{"coin":"x"}') for k in range(3000)], "h int, t binary").repartition(6)
    found = fields.message_fields(df, "t", F.col("h"))
    assert rows(found.select("period", "field", "family", "n_messages")) == [
        (h, "coin", "string", 1000) for h in range(3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") == 2 and "Sort" not in plan
