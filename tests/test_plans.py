"""What the plans must look like at scale."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.numbers import time_order
from millrace.operators import audit, capture, cleaning, profiling, quality, regression
from millrace.queries import QUERIES
from millrace.streaming import rollup

TABLES = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollectPublic()
    return execution.executedPlan().toString()


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{TABLES}/events.parquet")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, TABLES))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["anomaly_flags", "cdc_latest", "hourly_snapshot"])
def test_no_window_over_whole_keys(spark, name):
    assert "Window [" not in plan(QUERIES[name](spark, TABLES))


def test_cleaning_filters_before_the_shuffle_and_in_the_scan(spark, events):
    text = plan(cleaning.clean(events.select("event_type", "value")))
    assert text.index("Exchange") < text.index("Filter")
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value)]" in text
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert text.count("HashAggregate") == 2  # copies go before the shuffle as well


def test_checks_are_one_pass(spark, events):
    text = plan(quality.null_check(events, ["value", "ts"]))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_report_and_audits_read_the_table_once(spark, events):
    for df in (cleaning.cleaning_report(events),
               audit.drift_stats(events, F.to_date("ts"), "event_type", "value"),
               audit.population_stability(events, F.to_date("ts"), "event_type", "value", [1.0])):
        assert plan(df).count("FileScan") == 1


def test_bars_aggregate_by_hash(spark, events):
    order = time_order(F.col("ts"), F.col("event_id"))
    text = plan(rollup.hourly_bars(events, "ts", "event_type", "value", order))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_time_order(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (timestamp_ntz'2024-01-01', 9223372036854775807),
        (timestamp_ntz'2024-01-01 00:00:00.000001', -9223372036854775808),
        (timestamp_ntz'1900-01-01', 0), (timestamp_ntz'9999-12-31 23:59:59.999999', 1),
        (timestamp_ntz'2024-01-01', -9223372036854775808) AS t (ts, id)""")
    by_value = df.orderBy(time_order(F.col("ts"), F.col("id"))).collect()
    assert by_value == df.orderBy("ts", "id").collect()


def test_heads_keep_few_rows_per_task(spark, events):
    assert "TakeOrderedAndProject" in plan(profiling.head_rows(events, ["ts", "event_id"], 5))


def test_fit_reads_the_model_columns_only(spark, events):
    rows = events.select("*", F.col("value").alias("x_1"), F.col("event_id").cast("double").alias("y"))
    scored = regression.rmse(rows, regression.LinearModel(("x_1",), (1.0,), 0.0, 1))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan(scored)


def test_statistics_are_broadcast_by_their_size(spark, events):
    text = plan(audit.anomaly_flags(events, "event_type", "value"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_small_changes_do_not_shuffle_the_table(spark, events):
    base = spark.read.parquet(f"{TABLES}/customer.parquet").select("c_custkey", "c_acctbal")
    changes = events.select(F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"),
                            "event_id", F.lit("U").alias("op"))
    text = plan(capture.apply_changes(base, changes, "c_custkey", ["event_id"]))
    assert "LeftAnti" in text and "hashpartitioning" not in text


def test_a_hot_key_is_split_when_neither_side_is_small(spark):
    settings = {"spark.sql.shuffle.partitions": "64",
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    facts = spark.range(0, 300_000, 1, 8).select(
        F.md5(F.col("id").cast("string").cast("binary")).alias("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"))
    dimension = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("name"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for how in ("inner", "left"):
            assert "skew=true" in final_plan(audit.enrich(facts, dimension, "k", how))
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
