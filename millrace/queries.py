"""The registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from millrace.contracts import (ALPHA, BETAS, COPIED_ROWS, FEATURES_TABLE, NULL_ROWS, PRICE_ROW,
                                PRICES_TABLE, REGISTRY_TABLE, TABLES, Column, contract_of, required_columns)
from millrace.functions.messages import iso_utc, message_json
from millrace.functions.numbers import time_order
from millrace.operators import audit, capture, change, cleaning, parsing, profiling, quality
from millrace.operators import fields, regression, sampling, sketches
from millrace.plans import jobs
from millrace.session import work_dir
from millrace.sinks import catalog, slices
from millrace.sinks.files import append_run, read_runs, staged
from millrace.sources.streams import parquet_stream
from millrace.sources.synthetic import ROW_KEY, linear_rows, pollute
from millrace.sources.tables import scan_parquet
from millrace.streaming import anomalies, dedup, ingest, managed, rollup
from millrace.streaming.append import start_append

Query = Callable[[SparkSession, str], DataFrame]

# Bytes of source files that one micro-batch takes on.
BACKLOG = 1 << 40

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Inputs that several queries share, in Spark and in SQL --------------------------

def as_messages(events: DataFrame) -> DataFrame:
    """Events as the bytes of JSON messages, with three kinds of bad ones.

    The number in ``props`` decides: 0 is no JSON, 1 lacks its coin, 2 has a bad time.
    """
    k = F.col("k")
    text = message_json({
        "coin": F.when(k == "1", None).otherwise(F.col("event_type")),
        "usd": F.col("value"),
        "eur": F.col("value") / 2,
        "timestamp": F.when(k == "2", "x").otherwise(iso_utc(F.col("ts"))),
        "event_id": F.col("event_id"),
    })
    numbered = events.withColumn("k", F.regexp_extract("props", r'"k":\s*(\d+)', 1))
    return (numbered.select("k", text.alias("text"))
            .select(F.concat(F.when(k == "0", "#").otherwise(""), "text")
                    .cast("binary").alias("value")))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("x_1"), F.col("l_discount").alias("x_2"),
        F.col("l_tax").alias("x_3"), F.col("l_extendedprice").alias("y"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with NULL, NaN and copied rows, decided by the values themselves."""
    rows = features(spark, sf_dir)
    spoiled = rows.select(
        F.when(F.col("x_1") != 13, F.col("x_1")).alias("x_1"),
        F.when(F.col("x_2") == 0.1, float("nan")).otherwise(F.col("x_2")).alias("x_2"),
        "x_3", "y")
    times = F.when(F.col("x_3") == 0.08, 2).otherwise(1)
    return spoiled.select("*", F.explode(F.sequence(F.lit(1), times))).drop("col")


# What cleaning ``dirty`` has to return.
DIRTY_ROW = T.StructType([T.StructField(name, T.DoubleType()) for name in ("x_1", "x_2", "x_3", "y")])


def synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_rows(table(spark, sf_dir, "orders"), "o_orderkey")


FEATURES_SQL = """
    features AS (
        SELECT l_quantity AS x_1, l_discount AS x_2, l_tax AS x_3, l_extendedprice AS y
        FROM lineitem)"""

DIRTY_SQL = FEATURES_SQL + """,
    spoiled AS (
        SELECT CASE WHEN x_1 <> 13 THEN x_1 END AS x_1,
               CASE WHEN x_2 = 0.1 THEN 'nan'::DOUBLE ELSE x_2 END AS x_2, x_3, y
        FROM features),
    dirty AS (
        SELECT * FROM spoiled UNION ALL SELECT * FROM spoiled WHERE x_3 = 0.08),
    clean AS (
        SELECT DISTINCT * FROM dirty
        WHERE x_1 IS NOT NULL AND x_2 IS NOT NULL AND NOT isnan(x_2))"""

SENT_SQL = """
    sent AS (
        SELECT event_id, event_type AS coin, value AS usd, value / 2 AS eur, ts,
               json_extract_string(props, '$.k') AS k
        FROM events)"""

ACCEPTED_ROWS_SQL = """
    SELECT coin, usd, eur, ts AS event_timestamp FROM sent WHERE k NOT IN ('0', '1', '2')"""

ACCEPTED_SQL = f"""
    WITH {SENT_SQL} {ACCEPTED_ROWS_SQL}"""


def uniform_sql(i: int) -> str:
    start = i * 8 + 1
    return f"('0x' || substr(md5('0:0:' || o_orderkey), {start}, 8))::BIGINT / 4294967296.0::DOUBLE"


SYNTHETIC_SQL = f"""
    uniform AS (
        SELECT o_orderkey AS row_key, {uniform_sql(0)} AS x_1, {uniform_sql(1)} AS x_2,
               {uniform_sql(2)} AS x_3, {uniform_sql(3)} AS x_4
        FROM orders),
    synthetic AS (
        SELECT *, 10::DOUBLE * x_1 + 100::DOUBLE * x_2 + 1000::DOUBLE * x_3 + 0.5::DOUBLE * x_4
                  + 2.2::DOUBLE AS y
        FROM uniform)"""


# --- Sources and parsing -------------------------------------------------------------

@query(f"""
    WITH {SENT_SQL}
    SELECT coin, usd, eur, CASE WHEN k <> '2' THEN ts END AS event_timestamp
    FROM sent WHERE k NOT IN ('0', '1')""")
def parse_events(spark, sf_dir):
    return parsing.parse_messages(messages(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str, max_bytes: int | None = None) -> DataFrame:
    """The events as a stream; the pattern matches this name alone, be it a file or a folder."""
    schema = table(spark, sf_dir, "events").schema
    return parquet_stream(spark, f"{sf_dir.rstrip('/')}/event[s].parquet", schema,
                          max_bytes=max_bytes)


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Run the events through the streaming ingest once; the path of the sink."""
    stream = event_stream(spark, sf_dir, BACKLOG)
    path = work_dir(spark, "ingest")
    ingest.start_ingest(as_messages(stream), f"{path}/rows", f"{path}/checkpoint",
                        interval=None).awaitTermination()
    return f"{path}/rows"


@query(ACCEPTED_SQL)
def stream_ingest(spark, sf_dir):
    return ingest.read_accepted(spark, _ingested(spark, sf_dir))


# Batches of the managed table before some of their rows are sent again.
FIRST_SENT = 4


def _managed(spark: SparkSession, sf_dir: str, on_batch: Callable[[ingest.BatchReport], None] | None = None) -> str:
    """Events in four batches into the managed table, compacted, then a quarter of them again in
    two more, compacted. Each batch is a delivery, which the stream goes on with where it stopped."""
    path = work_dir(spark, "managed")

    def poll(rows: DataFrame, parts: int) -> None:
        for source in in_time_order(rows, f"{path}/in", "ts", parts):
            managed.start_managed(as_messages(source), f"{path}/rows", f"{path}/checkpoint", interval=None,
                                  on_batch=on_batch).awaitTermination()
        managed.compact(spark, f"{path}/rows")
    poll(table(spark, sf_dir, "events"), FIRST_SENT)
    poll(table(spark, sf_dir, "events").where("event_id % 4 = 0"), 2)
    return f"{path}/rows"


SENT_TWICE_SQL = f"""
    {SENT_SQL},
    twice AS (SELECT * FROM sent UNION ALL SELECT * FROM sent WHERE event_id % 4 = 0)"""


@query(f"""
    WITH {SENT_TWICE_SQL}
    SELECT coin, usd, eur, ts AS event_timestamp, true AS has_insert_time FROM twice WHERE k NOT IN ('0', '1', '2')""")
def stream_managed(spark, sf_dir):
    """Six batches in a table with keys and insert times, compacted twice."""
    return managed.read_managed(spark, _managed(spark, sf_dir)).select(
        *PRICE_ROW.names, F.col("inserted_at").isNotNull().alias("has_insert_time"))


def _in_order(rows: DataFrame, reports: list[ingest.BatchReport], again: int) -> DataFrame:
    """Whether the batches have, in the order of their keys, as many rows as were reported of them,
    and each has its keys and times above those of the one before; the times begin anew with
    batch ``again``."""
    sent = {r.batch_id: r.rows_accepted for r in reports if r.rows_accepted}
    counts = F.array(*[F.lit(sent[k]) for k in sorted(sent)]).cast("array<bigint>")
    by_key = Window.partitionBy().orderBy("first_id")  # one row for each batch
    at = F.row_number().over(by_key) - 1
    above = F.col("first_id") > F.lag("last_id").over(by_key)
    later = (F.col("first_time") > F.lag("last_time").over(by_key)) | (at == sum(k < again for k in sent))
    found = managed.batch_spans(rows).select(
        ((F.col("n") == F.get(counts, at)) & ((at == 0) | (above & later))).alias("ok"))
    return found.agg(((F.count_if("ok") == len(sent)) & (F.count("*") == len(sent))).alias("in_order"))


@query(f"""
    WITH {SENT_TWICE_SQL},
    n AS (SELECT count(*) AS rows_in, count(*) FILTER (WHERE k NOT IN ('0', '1', '2')) AS kept FROM twice)
    SELECT kept AS rows_accepted, kept AS distinct_ids, true AS in_order, rows_in, rows_in - kept AS rows_rejected, 2 AS compactions
    FROM n""")
def stream_managed_ids(spark, sf_dir):
    """Keys occur once, and ascend from batch to batch, as rows of a later time are in a later one."""
    reports: list[ingest.BatchReport] = []
    path = _managed(spark, sf_dir, reports.append)
    rows = managed.read_managed(spark, path)
    ids = rows.agg(F.count("*").alias("rows_accepted"), F.count_distinct("id").alias("distinct_ids"))
    ids = ids.withColumn("in_order", _in_order(rows, reports, FIRST_SENT).scalar())
    log = managed.managed_batches(spark, path).agg(
        F.sum("rows_in").alias("rows_in"), F.sum(F.col("rows_in") - F.col("rows_accepted")).alias("rows_rejected"),
        F.count_if(F.col("last_batch") > F.col("first_batch")).cast("int").alias("compactions"))
    return ids.select("*", *[log.select(c).scalar().alias(c) for c in ("rows_in", "rows_rejected", "compactions")])


REJECTED_SQL = f"""
    WITH {SENT_SQL}
    SELECT event_id, CASE WHEN k = '2' THEN coin END AS coin,
           CASE k WHEN '0' THEN 'malformed' WHEN '1' THEN 'missing_key'
                  ELSE 'bad_timestamp' END AS reject_reason
    FROM sent WHERE k IN ('0', '1', '2')"""


def _with_event_id(rejects: DataFrame) -> DataFrame:
    number = F.regexp_extract(parsing.RAW, r'"event_id":(\d+)', 1).cast("bigint")
    return rejects.select(number.alias("event_id"), "coin", parsing.REASON)


@query(REJECTED_SQL)
def stream_rejects(spark, sf_dir):
    return _with_event_id(ingest.read_rejected(spark, _ingested(spark, sf_dir)))


@query(f"""
    WITH {SENT_SQL}
    SELECT coin AS key, coin, usd, eur,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
           '2024-02-01T00:00:00.000000+00:00' AS published_at
    FROM sent""")
def to_json_messages(spark, sf_dir):
    """Fields are read back from the JSON text, as engines print numbers differently."""
    events = table(spark, sf_dir, "events")
    out = parsing.to_messages(events, F.col("event_type"), {
        "coin": F.col("event_type"), "usd": F.col("value"), "eur": F.col("value") / 2,
        "timestamp": iso_utc(F.col("ts")),
        "published_at": F.lit("2024-02-01T00:00:00.000000+00:00")})
    fields = "coin string, usd double, eur double, timestamp string, published_at string"
    return out.select("key", F.inline(F.array(F.from_json("value", fields))))


@query("""
    WITH flat AS (
        SELECT event_type AS coin, value AS usd, value / 2 AS eur, ts FROM events
        UNION ALL
        SELECT event_type || '_total', value * 2, NULL, ts FROM events)
    SELECT coin, usd, eur, ts AS timestamp FROM flat
    WHERE coin IN ('click', 'click_total', 'purchase', 'purchase_total', 'view')""")
def flatten_nested(spark, sf_dir):
    document = F.to_json(F.create_map(
        F.col("event_type"), F.create_map(F.lit("usd"), F.col("value"),
                                          F.lit("eur"), F.col("value") / 2),
        F.concat("event_type", F.lit("_total")), F.create_map(F.lit("usd"), F.col("value") * 2)))
    documents = table(spark, sf_dir, "events").select(document.alias("value"),
                                                      F.col("ts").alias("timestamp"))
    return parsing.flatten_prices(documents, coins=["click", "click_total", "purchase",
                                                    "purchase_total", "view"])


@query("SELECT * FROM lineitem")
def scan_full(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query("SELECT event_id, event_type, value, ts FROM events")
def scan_projected(spark, sf_dir):
    return scan_parquet(spark, f"{sf_dir.rstrip('/')}/events.parquet",
                        ["event_id", "event_type", "value", "ts"])


@query(f"WITH {SYNTHETIC_SQL} SELECT * FROM synthetic")
def synth_linear(spark, sf_dir):
    return synthetic(spark, sf_dir)


# --- Cleaning ------------------------------------------------------------------------

def draws_sql(rows: str, key: str, n: int) -> str:
    """Tables ``chosen`` (draw, key): the formula of ``sample_rows`` over a table of keys."""
    return f"""
    side AS (SELECT count(*) AS total, (2 ** greatest(0, ceil(log2(sqrt(greatest(
                 1.0, count(*) / {sampling.BUCKET_ROWS}.0))))))::BIGINT AS side FROM {rows}),
    placed AS (SELECT {key} AS key, ('0x' || substr(md5('0:' || {key}), 1, 8))::BIGINT % (side * side)
                   AS bucket FROM {rows}, side),
    ends AS (SELECT bucket, count(*) AS n, sum(count(*)) OVER (ORDER BY bucket) AS until
             FROM placed GROUP BY bucket),
    draws AS (SELECT range AS draw, ('0x' || substr(md5('0:' || range || ':position'), 1, 15))::BIGINT
                  % total AS position FROM range({n}), side),
    chosen AS (
        SELECT draw::INTEGER AS draw, arg_min(key, md5('0:' || draw || ':' || key)) AS {key}
        FROM draws JOIN ends ON position >= until - n AND position < until JOIN placed USING (bucket)
        GROUP BY draw)"""


@query(f"""
    WITH {SYNTHETIC_SQL},
    extended AS (
        SELECT * FROM synthetic
        UNION ALL
        SELECT -1 - range, NULL, NULL, NULL, NULL, NULL FROM range({NULL_ROWS})),
    {draws_sql('extended', 'row_key', COPIED_ROWS)}
    SELECT x_1, x_2, x_3, x_4, y FROM extended
    UNION ALL
    SELECT x_1, x_2, x_3, x_4, y FROM chosen JOIN extended USING (row_key)""")
def pollute_union(spark, sf_dir):
    return pollute(synthetic(spark, sf_dir), ROW_KEY)


@query(f"WITH {DIRTY_SQL} SELECT DISTINCT * FROM dirty")
def dedup_rows(spark, sf_dir):
    return cleaning.drop_copies(dirty(spark, sf_dir))


@query(f"WITH {DIRTY_SQL} SELECT * FROM clean")
def clean_rows(spark, sf_dir):
    return cleaning.clean(dirty(spark, sf_dir))


@query(f"""
    WITH {DIRTY_SQL}
    SELECT (SELECT count(*) FROM dirty) AS rows_before,
           (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS distinct_rows,
           (SELECT count(*) FROM clean) AS rows_after,
           (SELECT count(*) FROM dirty) - (SELECT count(*) FROM clean) AS dropped_rows""")
def clean_report(spark, sf_dir):
    return cleaning.cleaning_report(dirty(spark, sf_dir))


@query(f"WITH {DIRTY_SQL} SELECT * FROM clean")
def append_clean(spark, sf_dir):
    """Written twice under the same run, as a retry would; the rows are there once."""
    path = work_dir(spark, "features")
    rows = cleaning.clean(dirty(spark, sf_dir))
    append_run(rows, path, "first")
    append_run(rows, path, "first")
    return jobs.run_slice(spark, path, "first")


@query(f"WITH {draws_sql('events', 'event_id', COPIED_ROWS)} SELECT * FROM chosen JOIN events USING (event_id)")
def bootstrap_sample(spark, sf_dir):
    return sampling.sample_rows(table(spark, sf_dir, "events"), "event_id", COPIED_ROWS)


@query(f"WITH {draws_sql('events', 'event_id', 1000)} SELECT * FROM chosen JOIN events USING (event_id)")
def bootstrap_sample_many(spark, sf_dir):
    return sampling.sample_rows(table(spark, sf_dir, "events"), "event_id", 1000)


# --- Quality -------------------------------------------------------------------------

@query(f"""
    WITH {DIRTY_SQL}
    SELECT 'x_1' AS column_name, count(*) FILTER (WHERE x_1 IS NULL) AS null_count,
           count(*) AS total_rows FROM dirty
    UNION ALL SELECT 'x_2', count(*) FILTER (WHERE x_2 IS NULL OR isnan(x_2)), count(*) FROM dirty
    UNION ALL SELECT 'x_3', count(*) FILTER (WHERE x_3 IS NULL OR isnan(x_3)), count(*) FROM dirty
    UNION ALL SELECT 'y', count(*) FILTER (WHERE y IS NULL OR isnan(y)), count(*) FROM dirty""")
def null_counts(spark, sf_dir):
    return quality.null_counts_by_column(dirty(spark, sf_dir))


@query(f"""
    WITH {DIRTY_SQL}
    SELECT count(*) FILTER (WHERE x_1 IS NULL OR x_2 IS NULL OR isnan(x_2)) AS null_rows,
           count(*) AS total_rows
    FROM dirty""")
def null_rows(spark, sf_dir):
    return cleaning.null_rows(dirty(spark, sf_dir))


def _checks(spark: SparkSession, sf_dir: str, fail_on_empty: bool) -> DataFrame:
    """The null check on a clean, a dirty and an empty table."""
    names = ["x_1", "x_2", "x_3", "y"]
    good = features(spark, sf_dir)
    frames = {"clean": good, "dirty": dirty(spark, sf_dir), "empty": good.where(F.lit(False))}
    reports = [
        quality.null_check(df, names, fail_on_empty).select(
            F.lit(name).alias("table_name"), "passed", "reason", "total_rows", "total_nulls",
            *[F.col("nulls_by_column")[c].alias(f"nulls_{c}") for c in names],
            F.array_join("columns_checked", ",").alias("columns_checked"))
        for name, df in frames.items()]
    return reduce(DataFrame.unionByName, reports)


def checks_sql(fail_on_empty: bool) -> str:
    passed, reason = "x_1 + x_2 = 0", "NULL::VARCHAR"
    if fail_on_empty:
        passed += " AND n > 0"
        reason = f"CASE WHEN n = 0 THEN '{quality.EMPTY}' END"

    def counts(name: str, source: str) -> str:
        return f"""
        SELECT '{name}' AS table_name, count(*) AS n, count(*) FILTER (WHERE x_1 IS NULL) AS x_1,
               count(*) FILTER (WHERE x_2 IS NULL OR isnan(x_2)) AS x_2,
               count(*) FILTER (WHERE x_3 IS NULL) AS x_3, count(*) FILTER (WHERE y IS NULL) AS y
        FROM {source}"""
    return f"""
    WITH {DIRTY_SQL},
    counts AS ({counts('clean', 'features')} UNION ALL {counts('dirty', 'dirty')}
               UNION ALL {counts('empty', 'features WHERE false')})
    SELECT table_name, {passed} AS passed, {reason} AS reason, n AS total_rows,
           x_1 + x_2 + x_3 + y AS total_nulls, x_1 AS nulls_x_1, x_2 AS nulls_x_2,
           x_3 AS nulls_x_3, y AS nulls_y, 'x_1,x_2,x_3,y' AS columns_checked
    FROM counts"""


@query(checks_sql(fail_on_empty=True))
def null_check_strict(spark, sf_dir):
    return _checks(spark, sf_dir, fail_on_empty=True)


@query(checks_sql(fail_on_empty=False))
def null_check_lenient(spark, sf_dir):
    return _checks(spark, sf_dir, fail_on_empty=False)


@query(f"""
    SELECT 'broken' AS table_name, c.*, n.total_rows, false AS passed, NULL::VARCHAR AS reason
    FROM (VALUES ('l_orderkey', 'int', 'bigint', 'ok'), ('l_linenumber', 'float', 'int', 'wrong_type'),
                 ('l_quantity', 'float', 'double', 'ok'), ('l_returnflag', 'string', 'string', 'ok'),
                 ('l_comment', 'string', NULL, 'missing'), ('l_partkey', NULL, 'bigint', 'extra'),
                 ('l_suppkey', NULL, 'bigint', 'extra'), ('l_extendedprice', NULL, 'double', 'extra'),
                 ('l_discount', NULL, 'double', 'extra'), ('l_tax', NULL, 'double', 'extra'),
                 ('l_linestatus', NULL, 'string', 'extra'),
                 ('l_shipdate', NULL, 'timestamp_ntz', 'extra'))
         AS c (column_name, expected, observed, status),
         (SELECT count(*) AS total_rows FROM lineitem) AS n
    UNION ALL
    SELECT table_name, column_name, expected, observed, status, total_rows, total_rows > 0,
           CASE WHEN total_rows = 0 THEN '{quality.EMPTY}' END
    FROM (VALUES ('r_regionkey', 'int', 'int', 'ok'), ('r_name', 'string', 'string', 'ok'))
             AS c (column_name, expected, observed, status),
         (SELECT 'kept' AS table_name, count(*) AS total_rows FROM region
          UNION ALL SELECT 'empty', count(*) FROM region WHERE r_name = '')""")
def schema_contract(spark, sf_dir):
    """A contract that is broken, one that is kept, and one kept by no row at all."""
    contract = {"l_orderkey": Column("int"), "l_linenumber": Column("float"),
                "l_quantity": Column("float"), "l_returnflag": Column("string"),
                "l_comment": Column("string")}
    region, two = table(spark, sf_dir, "region"), {"r_regionkey": Column("int"), "r_name": Column("string")}
    reports = {"broken": quality.schema_report(table(spark, sf_dir, "lineitem"), contract),
               "kept": quality.schema_report(region, two),
               "empty": quality.schema_report(region.where("r_name = ''"), two)}
    return reduce(DataFrame.unionByName, [report.select(F.lit(name).alias("table_name"), "*")
                                          for name, report in reports.items()])


@query(f"""
    WITH {FEATURES_SQL}
    SELECT * FROM features
    WHERE (SELECT count(*) > 0 AND count(*) = count(x_1) AND count(*) = count(y) FROM features)""")
def gate_open(spark, sf_dir):
    rows = features(spark, sf_dir)
    return quality.gate(rows, quality.null_check(rows, ["x_1", "x_2", "x_3", "y"]))


@query(f"""
    WITH {DIRTY_SQL}
    SELECT count(*) AS rows_passed FROM dirty
    WHERE (SELECT count(*) > 0 AND count(*) = count(x_1) FROM dirty)""")
def gate_closed(spark, sf_dir):
    rows = dirty(spark, sf_dir)
    through = quality.gate(rows, quality.null_check(rows, ["x_1", "x_2", "x_3", "y"]))
    return through.agg(F.count("*").alias("rows_passed"))


@query(f"""
    WITH {FEATURES_SQL}
    SELECT 'x_1' AS column_name, false AS is_error, count(*) AS total_rows FROM features
    UNION ALL SELECT 'absent', true, count(*) FROM features""")
def null_check_missing_column(spark, sf_dir):
    """A null check of a column that is not there is an error, not a failed check."""
    rows, outcomes = features(spark, sf_dir), []
    for name in ("x_1", "absent"):
        try:
            quality.null_check(rows, [name])
            outcomes.append((name, False))
        except AnalysisException:
            outcomes.append((name, True))
    told = spark.createDataFrame(outcomes, "column_name string, is_error boolean")
    return told.withColumn("total_rows", rows.agg(F.count("*")).scalar())


# Contracts of two environments, as a file of settings has them.
CONTRACTS = {
    "strict": {"x_1": {"type": "float", "nullable": False}, "x_2": {"type": "float", "nullable": False}},
    "loose": {"x_1": {"type": "float", "nullable": True}, "x_3": {"type": "int"}, "z": {"type": "string", "nullable": True}},
}


@query(f"""
    WITH {DIRTY_SQL},
    n AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE x_1 IS NULL) AS x_1,
                 count(*) FILTER (WHERE x_2 IS NULL OR isnan(x_2)) AS x_2, count(*) FILTER (WHERE x_3 IS NULL) AS x_3 FROM dirty)
    SELECT c.*, n.total_rows, CASE WHEN environment = 'strict' THEN x_1 + x_2 ELSE x_3 END AS required_nulls
    FROM n, (VALUES ('strict', 'x_1', 'float', 'ok', true), ('strict', 'x_2', 'float', 'ok', true),
                    ('strict', 'x_3', NULL, 'extra', true), ('strict', 'y', NULL, 'extra', true),
                    ('loose', 'x_1', 'float', 'ok', false), ('loose', 'x_2', NULL, 'extra', false),
                    ('loose', 'x_3', 'int', 'wrong_type', false), ('loose', 'y', NULL, 'extra', false),
                    ('loose', 'z', 'string', 'missing', false)) AS c (environment, column_name, expected, status, passed)""")
def contract_from_data(spark, sf_dir):
    """Contracts read from plain data; the nulls of the columns that each requires."""
    rows, reports = dirty(spark, sf_dir), []
    for name, spec in CONTRACTS.items():
        contract = contract_of(spec)
        nulls = quality.null_check(rows, required_columns(contract)).select("total_nulls").scalar()
        reports.append(quality.schema_report(rows, contract).select(
            F.lit(name).alias("environment"), "column_name", "expected", "status", "passed", "total_rows",
            nulls.alias("required_nulls")))
    return reduce(DataFrame.unionByName, reports)


# --- Profiles, metrics, change detection ---------------------------------------------

@query("SELECT * FROM events ORDER BY ts, event_id LIMIT 10")
def head_rows(spark, sf_dir):
    return profiling.head_rows(table(spark, sf_dir, "events"), ["ts", "event_id"], 10)


@query("SELECT DISTINCT event_type FROM events")
def distinct_values(spark, sf_dir):
    return profiling.distinct_values(table(spark, sf_dir, "events"), "event_type")


@query("""
    SELECT 'events' AS source, count(*) AS num_rows, 6 AS num_cols FROM events
    UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
    UNION ALL SELECT 'orders', count(*), 6 FROM orders""")
def profile(spark, sf_dir):
    return reduce(DataFrame.unionByName, [profiling.profile(table(spark, sf_dir, name), name)
                                          for name in ("events", "lineitem", "orders")])


@query(f"""
    WITH {SENT_SQL}
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE k NOT IN ('0', '1', '2')) AS rows_accepted,
           count(*) FILTER (WHERE k IN ('0', '1', '2')) AS rows_rejected
    FROM sent""")
def run_metrics(spark, sf_dir):
    """Summed over batches, as the number of batches depends on the number of files."""
    batches = ingest.batch_counts(spark, _ingested(spark, sf_dir))
    return batches.agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_accepted", "rows_rejected")])


@query(f"""
    WITH {DIRTY_SQL},
    counts AS (SELECT (SELECT count(*) FROM dirty) AS b, (SELECT count(*) FROM clean) AS a)
    SELECT 'first' AS run_id, 'clean' AS step, metric, value::DOUBLE AS value, NULL::VARCHAR AS text
    FROM counts, LATERAL (VALUES ('rows_before', b), ('rows_after_cleaning', a),
                                 ('dropped_rows', b - a), ('num_cols', 4)) AS v (metric, value)""")
def job_metrics(spark, sf_dir):
    """What the cleaning job reports, recorded twice as by a retry."""
    path = work_dir(spark, "job")
    for _ in range(2):
        jobs.etl_job(dirty(spark, sf_dir), f"{path}/features", "first", f"{path}/metrics", DIRTY_ROW)
    return spark.read.parquet(f"{path}/metrics")


@query(ACCEPTED_SQL)
def snapshot_full(spark, sf_dir):
    """Stream to staging table, growth beyond the cursor, full copy, cursor, read back."""
    staging = _ingested(spark, sf_dir)
    path = work_dir(spark, "snapshot")
    change.create_cursors(spark, f"{path}/cursors")
    jobs.snapshot_job(spark, PRICES_TABLE, lambda: ingest.read_accepted(spark, staging),
                      f"{path}/cursors", f"{path}/copies", PRICE_ROW.names)
    return jobs.read_latest_snapshot(spark, PRICES_TABLE, f"{path}/cursors")


@query(ACCEPTED_SQL)
def snapshot_increment(spark, sf_dir):
    """The same copy kept up by a stream, polled twice; the second poll finds nothing new."""
    path = work_dir(spark, "increment")
    for _ in range(2):
        messages_in = as_messages(event_stream(spark, sf_dir, BACKLOG))
        rows = parsing.accepted(parsing.sort_messages(messages_in))
        start_append(rows, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return scan_parquet(spark, f"{path}/rows")


@query(f"""
    WITH {SENT_TWICE_SQL}
    SELECT coin, usd, eur, ts AS event_timestamp FROM twice WHERE k NOT IN ('0', '1', '2')""")
def snapshot_managed(spark, sf_dir):
    """A snapshot that is a place in the log of a managed table; nothing is copied."""
    path, cursors = _managed(spark, sf_dir), work_dir(spark, "cursors")
    change.create_cursors(spark, cursors)
    jobs.snapshot_managed(spark, PRICES_TABLE, path, cursors)
    return jobs.read_managed_snapshot(spark, PRICES_TABLE, cursors).select(*PRICE_ROW.names)


@query("""
    WITH state AS (
        SELECT 'customer' AS source, (SELECT count(*) + 1 FROM customer) AS last_count,
               (SELECT count(*) FROM customer) AS current_count
        UNION ALL SELECT 'events', NULL, (SELECT count(*) FROM events)
        UNION ALL SELECT 'lineitem',
                  (SELECT count(*) - 1 FROM lineitem),
                  (SELECT count(*) FROM lineitem)
        UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders))
    SELECT source, last_count, current_count,
           current_count > coalesce(last_count, 0) AS fires,
           CASE WHEN current_count > coalesce(last_count, 0) THEN current_count ELSE last_count END
               AS new_cursor,
           CASE WHEN current_count > coalesce(last_count, 0)
                THEN source || '_ingest_' || current_count END AS run_key
    FROM state""")
def new_rows_since(spark, sf_dir):
    """Cursors that are ahead, absent, behind and equal."""
    tables = {name: table(spark, sf_dir, name)
              for name in ("customer", "events", "lineitem", "orders")}
    former = {"customer": tables["customer"].agg((F.count("*") + 1).alias("last_count")),
              "lineitem": tables["lineitem"].agg((F.count("*") - 1).alias("last_count")),
              "orders": tables["orders"].agg(F.count("*").alias("last_count"))}
    cursors = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("source"), "*")
                                             for name, df in former.items()])
    return change.new_rows_since(change.current_counts(tables), cursors)


# --- Regression ----------------------------------------------------------------------

def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


SINGLE_SQL = """
    model AS (
        SELECT regr_slope(y, x_1) AS slope, regr_intercept(y, x_1) AS intercept FROM features)"""


@query(f"""
    WITH {FEATURES_SQL}, {SINGLE_SQL}
    SELECT 'x_1' AS term, round(slope, 4) AS coefficient FROM model
    UNION ALL SELECT 'intercept', round(intercept, 4) FROM model""")
def ols_fit_single(spark, sf_dir):
    model = regression.fit_linear(features(spark, sf_dir), ["x_1"])
    return _rounded(model.terms(spark), 4, "coefficient")


THREE_SQL = """
    m AS (
        SELECT var_pop(x_1) AS a, covar_pop(x_1, x_2) AS b, covar_pop(x_1, x_3) AS c,
               var_pop(x_2) AS d, covar_pop(x_2, x_3) AS e, var_pop(x_3) AS f,
               covar_pop(x_1, y) AS p, covar_pop(x_2, y) AS q, covar_pop(x_3, y) AS r,
               avg(x_1) AS m1, avg(x_2) AS m2, avg(x_3) AS m3, avg(y) AS my
        FROM clean),
    det AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM m),
    s AS (
        SELECT *, (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det AS b1,
               (a * (q * f - e * r) - p * (b * f - c * e) + c * (b * r - q * c)) / det AS b2,
               (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - c * d)) / det AS b3
        FROM det)"""


MULTI_SQL = f"""
    WITH {DIRTY_SQL}, {THREE_SQL}
    SELECT 'x_1' AS term, round(b1, 4) AS coefficient FROM s
    UNION ALL SELECT 'x_2', round(b2, 4) FROM s
    UNION ALL SELECT 'x_3', round(b3, 4) FROM s
    UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2 - b3 * m3, 4) FROM s"""


@query(MULTI_SQL)
def ols_fit_multi(spark, sf_dir):
    model = regression.fit_linear(cleaning.clean(dirty(spark, sf_dir)))
    return _rounded(model.terms(spark), 4, "coefficient")


# The features of ``wide``: those of ``features`` and how often each occurs.
COPIES = {"x_1": 3, "x_2": 3, "x_3": 2}


@query(f"""
    WITH {DIRTY_SQL}, {THREE_SQL}
    SELECT 'x_' || (i * 3 + v.f) AS term, round(share / copies, 4) AS coefficient
    FROM s, LATERAL (VALUES (1, b1, {COPIES['x_1']}), (2, b2, {COPIES['x_2']}), (3, b3, {COPIES['x_3']}))
            AS v (f, share, copies), range(3) AS r (i) WHERE i < copies
    UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2 - b3 * m3, 4) FROM s""")
def ols_fit_wide(spark, sf_dir):
    """Eight features, copies of three: the least-norm solution shares a weight out evenly."""
    rows = cleaning.clean(dirty(spark, sf_dir))
    wide = rows.select(*[F.col(f"x_{f}").alias(f"x_{i * 3 + f}") for i in range(3) for f in (1, 2, 3)
                         if i < COPIES[f"x_{f}"]], "y")
    return _rounded(regression.fit_linear(wide).terms(spark), 4, "coefficient")


@query(MULTI_SQL)
def ols_fit_merged(spark, sf_dir):
    """The same fit from the moments of three runs; the second is kept twice, as by a retry."""
    path, names = work_dir(spark, "moments"), ["x_1", "x_2", "x_3", "y"]
    rows = dirty(spark, sf_dir)
    # Equal rows are in the same run, as each run is cleaned on its own.
    part = F.pmod(F.xxhash64(*[F.nanvl(F.col(name), F.lit(None)) for name in names]), F.lit(3))
    for run in (0, 1, 2):
        jobs.etl_job(rows.where(part == run), f"{path}/features", f"run-{run}", declared=DIRTY_ROW)
    for run in (0, 1, 1, 2):
        jobs.moments_job(spark, f"{path}/features", f"{path}/moments", f"run-{run}", names)
    return _rounded(jobs.fit_runs(spark, f"{path}/moments").terms(spark), 4, "coefficient")


@query(f"""
    WITH {FEATURES_SQL}, {SINGLE_SQL}
    SELECT x_1, y, round(slope * x_1 + intercept, 4) AS prediction FROM features, model""")
def ols_predict(spark, sf_dir):
    rows = features(spark, sf_dir)
    model = regression.fit_linear(rows, ["x_1"])
    return _rounded(regression.predict(rows.select("x_1", "y"), model), 4, "prediction")


@query(f"""
    WITH {FEATURES_SQL}, {SINGLE_SQL}
    SELECT round(sqrt(avg(pow(y - (slope * x_1 + intercept), 2))), 4) AS rmse
    FROM features, model""")
def ols_rmse(spark, sf_dir):
    rows = features(spark, sf_dir)
    return _rounded(regression.rmse(rows, regression.fit_linear(rows, ["x_1"])), 4, "rmse")


@query(f"""
    WITH {FEATURES_SQL}, {SINGLE_SQL}
    SELECT './saved_models/linear_model_20240201_093005.parquet' AS model_path,
           round(sqrt(avg(pow(y - (slope * x_1 + intercept), 2))), 4) AS rmse,
           '["x_1"]' AS features
    FROM features, model""")
def registry_row(spark, sf_dir):
    rows = features(spark, sf_dir)
    model = regression.fit_linear(rows, ["x_1"])
    record = regression.registry_row(regression.rmse(rows, model), model, "./saved_models",
                                     datetime(2024, 2, 1, 9, 30, 5))
    return _rounded(record, 4, "rmse")


@query(f"""
    WITH {SYNTHETIC_SQL}
    SELECT term, coefficient, count(*) AS training_rows, 0::DOUBLE AS error
    FROM synthetic, (VALUES ('x_1', {BETAS[0]}::DOUBLE), ('x_2', {BETAS[1]}), ('x_3', {BETAS[2]}),
                            ('x_4', {BETAS[3]}), ('intercept', {ALPHA})) AS v (term, coefficient)
    GROUP BY term, coefficient""")
def train_model(spark, sf_dir):
    """Pollute, clean, append, check, fit and register; then read the model from the path
    that the registry has, and predict with it. The known answer must come back."""
    path = work_dir(spark, "train")
    raw = staged(pollute(synthetic(spark, sf_dir), ROW_KEY), "raw")
    jobs.etl_job(raw, f"{path}/features", "first")
    table = jobs.run_slice(spark, f"{path}/features", "first")
    jobs.training_job(table, f"{path}/registry", datetime(2024, 2, 1, 9, 30, 5), folder=f"{path}/models")
    record = jobs.run_slice(spark, f"{path}/registry", "20240201_093005").first()
    model = regression.LinearModel.load(spark, record["model_path"])
    error = regression.rmse(table, model).select(F.round("rmse", 6).alias("error"))
    return (_rounded(model.terms(spark), 6, "coefficient")
            .withColumn("training_rows", F.lit(model.rows).cast("bigint"))
            .withColumn("error", error.scalar()))


def _stored(spark: SparkSession, name: str, fill: Callable[[str], None]) -> DataFrame:
    """The rows of a catalog table that ``fill`` is given; the catalog forgets it again."""
    path = work_dir(spark, name)
    known = f"{name}_{path[-32:]}"
    catalog.create_table(spark, known, TABLES[name], path)
    try:
        fill(known)
    finally:
        spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": known})
    return spark.read.parquet(path)


@query(f"""
    WITH {SYNTHETIC_SQL},
    twice AS (SELECT * FROM synthetic UNION ALL SELECT * FROM synthetic)
    SELECT (row_number() OVER () - 1)::BIGINT AS id, true AS has_insert_time FROM twice""")
def managed_append(spark, sf_dir):
    """Two cleaned appends to the feature table: keys run on, and rows know when they came."""
    rows = synthetic(spark, sf_dir).drop(ROW_KEY)

    def fill(name: str) -> None:
        for _ in range(2):
            jobs.etl_to_table(rows, name)
    return _stored(spark, FEATURES_TABLE, fill).select(
        "id", F.col("inserted_at").isNotNull().alias("has_insert_time"))


@query(f"""
    WITH {FEATURES_SQL}, {SINGLE_SQL}
    SELECT i.range::BIGINT AS id, './saved_models/linear_model_20240201_093005.parquet' AS model_path,
           round(sqrt(avg(pow(y - (slope * x_1 + intercept), 2))), 4) AS rmse,
           '["x_1"]' AS features, true AS has_insert_time
    FROM features, model, range(2) AS i GROUP BY i.range""")
def registry_insert(spark, sf_dir):
    """The record of a fit, inserted twice into the registry table."""
    rows = features(spark, sf_dir)
    model = regression.fit_linear(rows, ["x_1"])
    record = regression.registry_row(regression.rmse(rows, model), model, "./saved_models",
                                     datetime(2024, 2, 1, 9, 30, 5)).first().asDict()

    def fill(name: str) -> None:
        for _ in range(2):
            catalog.insert_row(spark, name, record)
    stored = _stored(spark, REGISTRY_TABLE, fill)
    return _rounded(stored.withColumn("has_insert_time", F.col("inserted_at").isNotNull())
                    .drop("inserted_at"), 4, "rmse")


@query(f"""
    WITH {DIRTY_SQL},
    n AS (SELECT (SELECT count(*) FROM features) AS clean)
    SELECT 'clean' AS table_name, true AS passed, clean AS rows_published FROM n
    UNION ALL SELECT 'dirty', false, 0 FROM n""")
def blocked_publish(spark, sf_dir):
    """A table is published if its check passes, and otherwise not a row of it."""
    path, names = work_dir(spark, "published"), ["x_1", "x_2", "x_3", "y"]
    frames = {"clean": features(spark, sf_dir), "dirty": dirty(spark, sf_dir)}
    outcomes = [(name, *jobs.published(df, path, name, names)) for name, df in frames.items()]
    return spark.createDataFrame(outcomes, "table_name string, passed boolean, rows_published bigint")


@query(f"""
    WITH {SENT_SQL}, accepted AS ({ACCEPTED_ROWS_SQL}),
    head AS (SELECT * FROM accepted ORDER BY event_timestamp, coin, usd LIMIT 5)
    SELECT 'row_count' AS metric, count(*)::DOUBLE AS value, NULL AS text FROM accepted
    UNION ALL SELECT 'num_cols', 4, NULL
    UNION ALL SELECT 'source', NULL, 'crypto_prices'
    UNION ALL SELECT DISTINCT 'distinct_values', NULL::DOUBLE, coin FROM accepted
    UNION ALL SELECT 'head', NULL, coin || ' ' || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') FROM head""")
def snapshot_metrics(spark, sf_dir):
    """What a snapshot reports beside its rows: counts, source, coins and first rows."""
    path = work_dir(spark, "snapshot")
    rows = staged(parsing.accepted(parsing.sort_messages(messages(spark, sf_dir))), "accepted")
    change.create_cursors(spark, f"{path}/cursors")
    jobs.snapshot_job(spark, PRICES_TABLE, lambda: rows, f"{path}/cursors", f"{path}/copies",
                      PRICE_ROW.names, f"{path}/metrics", ["event_timestamp", "coin", "usd"], "coin")
    head = F.from_json("text", "coin string, event_timestamp string")
    time = F.rpad(F.replace(head["event_timestamp"], F.lit("T"), F.lit(" ")), 26, "0")
    shown = F.when(F.col("metric") == "head", F.concat_ws(" ", head["coin"], time)).otherwise(F.col("text"))
    return spark.read.parquet(f"{path}/metrics").select("metric", "value", shown.alias("text"))


@query(f"""
    WITH {DIRTY_SQL},
    n AS (SELECT (SELECT count(*) FROM features) AS clean)
    SELECT 'clean' AS table_name, true AS passed, clean AS rows_published, clean AS rows_visible FROM n
    UNION ALL SELECT 'dirty', false, 0, 0 FROM n""")
def blocked_publish_once(spark, sf_dir):
    """The same by one pass, each table twice, as by a retry; what readers see of each."""
    path, names = work_dir(spark, "published"), ["x_1", "x_2", "x_3", "y"]
    frames = {"clean": features(spark, sf_dir), "dirty": dirty(spark, sf_dir)}
    outcomes = [(name, *jobs.published_once(df, path, name, names))
                for _ in range(2) for name, df in frames.items()][2:]
    shown = slices.read_slices(spark, path, DIRTY_ROW).groupBy("slice").agg(F.count("*").alias("n"))
    told = spark.createDataFrame(outcomes, "table_name string, passed boolean, rows_published bigint")
    return (told.join(shown, F.col("table_name") == F.col("slice"), "left")
            .select("table_name", "passed", "rows_published", F.coalesce("n", F.lit(0)).alias("rows_visible")))


# --- Change capture, staged validation and audits ------------------------------------

def spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with NULL and NaN values and NULL types, as the number of an event decides."""
    n = F.col("event_id")
    value = (F.when(n % 17 == 0, float("nan")).when(n % 19 == 0, None).otherwise(F.col("value")))
    kind = F.when(n % 23 != 0, F.col("event_type"))
    return table(spark, sf_dir, "events").withColumns({"value": value, "event_type": kind})


# ``v`` is the value where there is one: neither NULL nor NaN.
SPOILED_SQL = """
    spoiled AS (
        SELECT event_id, ts, user_id, CASE WHEN event_id % 23 <> 0 THEN event_type END AS event_type,
               CASE WHEN event_id % 17 = 0 THEN 'nan'::DOUBLE WHEN event_id % 19 <> 0 THEN value END AS value,
               CASE WHEN event_id % 17 <> 0 AND event_id % 19 <> 0 THEN value END AS v
        FROM events)"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes; some have no operation, an unknown one, or no key."""
    kind, n = F.col("event_type"), F.col("event_id")
    op = (F.when(n % 29 == 0, None).when(n % 31 == 0, "X").when(kind == "error", "D")
          .when(kind == "signup", "I").otherwise("U"))
    return table(spark, sf_dir, "events").select(
        F.when(n % 37 != 0, F.col("user_id")).alias("c_custkey"), F.col("value").alias("c_acctbal"),
        "ts", "event_id", op.alias("op"))


CHANGES_SQL = """
    changes AS (
        SELECT CASE WHEN event_id % 37 <> 0 THEN user_id END AS c_custkey, value AS c_acctbal, ts, event_id,
               CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'X'
                    WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I'
                    ELSE 'U' END AS op
        FROM events),
    latest AS (
        SELECT * FROM changes WHERE op IN ('I', 'U', 'D') AND c_custkey IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY ts DESC, event_id DESC) = 1)"""


@query(f"WITH {CHANGES_SQL} SELECT * FROM latest WHERE op <> 'D'")
def cdc_latest(spark, sf_dir):
    return capture.latest_changes(_changes(spark, sf_dir), "c_custkey", ["ts", "event_id"])


@query(f"""
    WITH {CHANGES_SQL}
    SELECT * FROM changes WHERE op IS NULL OR op = 'X' OR c_custkey IS NULL""")
def cdc_invalid(spark, sf_dir):
    return capture.invalid_changes(_changes(spark, sf_dir), "c_custkey")


APPLIED_SQL = f"""
    WITH {CHANGES_SQL},
    base AS (SELECT CASE WHEN c_custkey % 41 <> 0 THEN c_custkey END AS c_custkey, c_acctbal FROM customer)
    SELECT c_custkey, c_acctbal FROM latest WHERE op <> 'D'
    UNION ALL
    SELECT c_custkey, c_acctbal FROM base
    WHERE c_custkey IS NULL OR c_custkey NOT IN (SELECT c_custkey FROM latest)"""


@query(APPLIED_SQL)
def cdc_apply(spark, sf_dir):
    key = F.when(F.col("c_custkey") % 41 != 0, F.col("c_custkey")).alias("c_custkey")
    base = table(spark, sf_dir, "customer").select(key, "c_acctbal")
    return capture.apply_changes(base, _changes(spark, sf_dir), "c_custkey", ["ts", "event_id"])


@query(APPLIED_SQL)
def cdc_apply_buckets(spark, sf_dir):
    """Kept as buckets, of which only those that have changes are rewritten; applied twice."""
    path = work_dir(spark, "buckets")
    key = F.when(F.col("c_custkey") % 41 != 0, F.col("c_custkey")).alias("c_custkey")
    base = table(spark, sf_dir, "customer").select(key, "c_acctbal")
    capture.write_buckets(base, path, "c_custkey", 16)
    for _ in range(2):
        capture.apply_to_buckets(spark, path, base.schema, _changes(spark, sf_dir), "c_custkey", ["ts", "event_id"])
    return capture.read_buckets(spark, path, base.schema).drop("slice")


@query(ACCEPTED_SQL)
def split_valid(spark, sf_dir):
    return parsing.accepted(parsing.sort_messages(messages(spark, sf_dir)))


@query(REJECTED_SQL)
def split_rejected(spark, sf_dir):
    return _with_event_id(parsing.rejected(parsing.sort_messages(messages(spark, sf_dir))))


@query("""
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment, n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def enrich_dim(spark, sf_dir):
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    with_customer = audit.enrich(orders, customer, F.col("o_custkey") == F.col("c_custkey"))
    return (audit.enrich(with_customer, nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment", "n_name"))


@query(f"""
    WITH {SENT_SQL},
    raw AS (SELECT coin, CAST(ts AS DATE) AS day, count(*) AS n FROM sent GROUP BY ALL),
    kept AS (SELECT coin, CAST(ts AS DATE) AS day, count(*) AS n FROM sent
             WHERE k NOT IN ('0', '1', '2') GROUP BY ALL)
    SELECT coalesce(raw.coin, kept.coin) AS coin, coalesce(raw.day, kept.day) AS day,
           coalesce(raw.n, 0) AS raw_rows, coalesce(kept.n, 0) AS clean_rows,
           coalesce(raw.n, 0) - coalesce(kept.n, 0) AS missing_rows
    FROM raw FULL JOIN kept ON raw.coin = kept.coin AND raw.day = kept.day""")
def reconcile_counts(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(F.col("event_type").alias("coin"),
                                                F.to_date("ts").alias("day"))
    kept = parsing.accepted(parsing.sort_messages(messages(spark, sf_dir)))
    clean = kept.select("coin", F.to_date("event_timestamp").alias("day"))
    return audit.reconcile_counts(raw, clean, ["coin", "day"])


# Orders as two systems have them: some rows are missing, changed, there twice or new, and
# every seventh has no key.
ORDERS_SQL = """
    orders_left AS (
        SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey, o_totalprice FROM orders),
    orders_right AS (
        SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey,
               o_totalprice + CASE WHEN o_orderkey % 1009 = 5 THEN 1 ELSE 0 END AS o_totalprice
        FROM orders, range(2) AS t (n) WHERE o_orderkey % 1013 <> 9 AND (n = 0 OR o_orderkey % 1019 = 4)
        UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 1021 = 6)"""


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    key = F.when(n % 7 != 0, n).alias("o_orderkey")
    times = F.sequence(F.lit(1), F.when(n % 1019 == 4, 2).otherwise(1))
    price = F.col("o_totalprice") + F.when(n % 1009 == 5, 1).otherwise(0)
    right = (orders.where(n % 1013 != 9).select(key, "o_custkey", price.alias("o_totalprice"), F.explode(times))
             .drop("col").unionByName(orders.where(n % 1021 == 6).withColumn("o_orderkey", -n)))
    return orders.select(key, "o_custkey", "o_totalprice"), right


@query(f"""
    WITH {ORDERS_SQL},
    counts AS (
        SELECT o_orderkey, sum(l) AS l, sum(r) AS r FROM (
            SELECT *, 1 AS l, 0 AS r FROM orders_left UNION ALL SELECT *, 0, 1 FROM orders_right)
        GROUP BY o_orderkey, o_custkey, o_totalprice)
    SELECT o_orderkey, CASE WHEN sum(greatest(r - l, 0)) = 0 THEN 'missing' WHEN sum(greatest(l - r, 0)) = 0 THEN 'extra'
                            ELSE 'changed' END AS status,
           sum(greatest(l - r, 0))::BIGINT AS left_only, sum(greatest(r - l, 0))::BIGINT AS right_only
    FROM counts WHERE l <> r GROUP BY o_orderkey""")
def reconcile_rows(spark, sf_dir):
    """Both tables are kept as buckets by key, so that only those that differ are compared."""
    path, sides = work_dir(spark, "reconcile"), []
    for name, df in zip(("left", "right"), _orders(spark, sf_dir)):
        capture.write_buckets(df, f"{path}/{name}", "o_orderkey", 64)
        sides.append(capture.read_buckets(spark, f"{path}/{name}", df.schema))
    return audit.reconcile_rows(*sides, "o_orderkey", bucket="slice")


@query("""
    WITH facts AS (
        SELECT event_id, CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS k,
               CASE WHEN event_id % 41 <> 0 THEN ts END AS seen FROM events),
    known AS (
        SELECT k, date_trunc('minute', ts) AS since, max((value, event_id)) AS d
        FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN -1 WHEN event_id % 8 <> 0 THEN user_id END AS k FROM events)
        WHERE event_type = 'purchase' AND k IS NOT NULL GROUP BY ALL)
    SELECT event_id, facts.k, seen, known.d[1] AS level, known.d[2] AS level_id
    FROM facts ASOF LEFT JOIN known ON facts.k = known.k AND seen >= since""")
def enrich_as_of(spark, sf_dir):
    """Events beside the last purchase of their user; a third of them has one user."""
    events, n = table(spark, sf_dir, "events"), F.col("event_id")
    facts = events.select("event_id", F.when(n % 37 != 0, F.when(n % 3 == 0, -1).otherwise(F.col("user_id"))).alias("k"),
                          F.when(n % 41 != 0, F.col("ts")).alias("seen"))
    known = events.where("event_type = 'purchase'").select(
        F.when(n % 9 == 0, -1).otherwise(F.when(n % 8 != 0, F.col("user_id"))).alias("k"),
        F.date_trunc("minute", "ts").alias("since"), F.col("value").alias("level"), n.alias("level_id"))
    return audit.enrich_as_of(facts, known, "k", "seen", "since", ["level", "level_id"])


@query(f"""
    WITH {SPOILED_SQL},
    stats AS (
        SELECT CAST(ts AS DATE) AS period, event_type, count(*) AS n_rows, avg(v) AS mean,
               stddev_samp(v) AS spread
        FROM spoiled GROUP BY ALL),
    base AS (
        SELECT event_type, mean AS ref_mean, spread AS ref_spread FROM stats
        QUALIFY period = min(period) OVER (PARTITION BY event_type))
    SELECT period, stats.event_type, n_rows, round(mean, 9) AS mean, round(spread, 9) AS spread,
           round(ref_mean, 9) AS ref_mean, round(ref_spread, 9) AS ref_spread,
           round((mean - ref_mean) / nullif(ref_spread, 0), 9) AS shift
    FROM stats LEFT JOIN base ON stats.event_type IS NOT DISTINCT FROM base.event_type""")
def drift_stats(spark, sf_dir):
    stats = audit.drift_stats(spoiled(spark, sf_dir), F.to_date("ts"), "event_type", "value")
    return _rounded(stats, 9, "mean", "spread", "ref_mean", "ref_spread", "shift")


@query(f"""
    WITH {SPOILED_SQL},
    bins AS (
        SELECT CAST(ts AS DATE) AS period, event_type, count(v) AS n_rows,
               count(*) FILTER (WHERE v < 10) AS b0,
               count(*) FILTER (WHERE v >= 10 AND v < 25) AS b1,
               count(*) FILTER (WHERE v >= 25 AND v < 50) AS b2,
               count(*) FILTER (WHERE v >= 50 AND v < 100) AS b3,
               count(*) FILTER (WHERE v >= 100) AS b4
        FROM spoiled GROUP BY ALL),
    long AS (
        UNPIVOT (SELECT period, event_type, n_rows,
                        greatest(coalesce(b0 / nullif(n_rows, 0), 0), 1e-4) AS b0,
                        greatest(coalesce(b1 / nullif(n_rows, 0), 0), 1e-4) AS b1,
                        greatest(coalesce(b2 / nullif(n_rows, 0), 0), 1e-4) AS b2,
                        greatest(coalesce(b3 / nullif(n_rows, 0), 0), 1e-4) AS b3,
                        greatest(coalesce(b4 / nullif(n_rows, 0), 0), 1e-4) AS b4 FROM bins)
        ON b0, b1, b2, b3, b4 INTO NAME bin VALUE share),
    base AS (
        SELECT event_type, bin, share AS ref FROM long
        QUALIFY period = min(period) OVER (PARTITION BY event_type))
    SELECT period, long.event_type, n_rows, round(sum((share - ref) * ln(share / ref)), 4) AS psi
    FROM long LEFT JOIN base ON long.event_type IS NOT DISTINCT FROM base.event_type
                            AND long.bin = base.bin
    GROUP BY period, long.event_type, n_rows""")
def drift_stability(spark, sf_dir):
    psi = audit.population_stability(spoiled(spark, sf_dir), F.to_date("ts"), "event_type", "value",
                                     [10.0, 25.0, 50.0, 100.0])
    return _rounded(psi, 4, "psi")


@query(f"""
    WITH {SPOILED_SQL},
    scored AS (
        SELECT event_id, event_type, value,
               (v - avg(v) OVER w) / nullif(stddev_samp(v) OVER w, 0) AS z
        FROM spoiled WINDOW w AS (PARTITION BY event_type))
    SELECT event_id, event_type, value, round(z, 4) AS z_score,
           coalesce(abs(z) > 3, false) AS is_anomaly
    FROM scored""")
def anomaly_flags(spark, sf_dir):
    events = spoiled(spark, sf_dir).select("event_id", "event_type", "value")
    return _rounded(audit.anomaly_flags(events, "event_type", "value"), 4, "z_score")


def in_time_order(df: DataFrame, path: str, time: str, parts: int = 4) -> Iterator[DataFrame]:
    """The rows in so many deliveries, one after the other by time: after each of them a stream
    of the folder, which has to be run before the next one is written.

    All new files are one batch, so a delivery is, and is written and read by as many tasks as
    there are. Rows without a time are in the first one.
    """
    spread = df.agg(F.min(time), F.max(time)).first()
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = (F.unix_micros(F.lit(v).cast("timestamp")) for v in spread)
    part = F.coalesce(F.floor((micros - low) * parts / (high - low + 1)), F.lit(0))
    for k in range(parts):
        df.where(part == k).write.mode("append").parquet(path)
        yield parquet_stream(df.sparkSession, path, df.schema)


@query(f"""
    WITH {SPOILED_SQL},
    days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM spoiled),
    before AS (
        SELECT days.event_type, days.day, avg(v) AS mean, stddev_samp(v) AS spread
        FROM days JOIN spoiled AS s ON s.event_type IS NOT DISTINCT FROM days.event_type AND CAST(s.ts AS DATE) < days.day
        GROUP BY ALL),
    scored AS (
        SELECT s.*, (v - mean) / nullif(spread, 0) AS z FROM spoiled AS s
        LEFT JOIN before ON s.event_type IS NOT DISTINCT FROM before.event_type AND CAST(s.ts AS DATE) = before.day)
    SELECT event_id, event_type, value, round(z, 4) AS z_score, coalesce(abs(z) > 3, false) AS is_anomaly FROM scored""")
def anomaly_stream(spark, sf_dir):
    """Scored in four batches against the days before, of which only moments are kept."""
    path, rows = work_dir(spark, "anomalies"), spoiled(spark, sf_dir)
    for stream in in_time_order(rows, f"{path}/in", "ts"):
        anomalies.start_anomalies(stream, f"{path}/out", f"{path}/checkpoint", "ts", "event_type", "value").awaitTermination()
    out = anomalies.read_scored(spark, f"{path}/out", rows.schema).select("event_id", "event_type", "value", "z_score", "is_anomaly")
    return _rounded(out, 4, "z_score")


def _resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four deliveries, with the delivery of each: some are sent twice in one, some
    again in the next, some of the first again in the last, and a few only there, too late."""
    events, n = table(spark, sf_dir, "events"), F.col("event_id")
    spread = events.agg(F.min("ts"), F.max("ts")).first()
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = (F.unix_micros(F.lit(v).cast("timestamp")) for v in spread)
    own = F.floor((micros - low) * 4 / (high - low + 1)).cast("int")
    held = (own == 0) & (n % 13 == 1)
    sent = F.when(held, F.array(F.lit(3))).otherwise(F.concat(
        F.array(own), F.when(n % 5 == 0, F.array(own)).otherwise(F.array().cast("array<int>")),
        F.when((n % 7 == 0) & (own < 3), F.array(own + 1)).otherwise(F.array().cast("array<int>")),
        F.when((n % 11 == 0) & (own == 0), F.array(F.lit(3))).otherwise(F.array().cast("array<int>"))))
    return events.select("*", F.explode(sent).alias("delivery"))


RESENT_SQL = """
    placed AS (
        SELECT *, floor((epoch_us(ts) - lo) * 4.0 / (hi - lo + 1))::INTEGER AS own
        FROM events, (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events)),
    marked AS (SELECT *, own = 0 AND event_id % 13 = 1 AS held FROM placed)"""


def _deduplicated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dedup.DedupReport]:
    path, rows = work_dir(spark, "dedup"), staged(_resent(spark, sf_dir), "resent")
    for k in range(4):
        rows.where(F.col("delivery") == k).drop("delivery").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = parquet_stream(spark, f"{path}/in", rows.drop("delivery").schema, max_files=1)
    run = dedup.start_dedup(stream, f"{path}/out", f"{path}/checkpoint", "event_id", "ts", "1 hour")
    run.awaitTermination()
    return scan_parquet(spark, f"{path}/out"), dedup.dedup_report(run.recentProgress)


@query(f"""
    WITH {RESENT_SQL}
    SELECT event_id, ts, user_id, event_type, value, props FROM marked WHERE NOT held""")
def stream_dedup(spark, sf_dir):
    """Four batches with repeats in them and across them, and late rows, which are left out."""
    return _deduplicated(spark, sf_dir)[0]


@query(f"""
    WITH {RESENT_SQL},
    n AS (SELECT count(*) FILTER (WHERE NOT held) AS kept, count(*) FILTER (WHERE held OR (own = 0 AND event_id % 11 = 0)) AS late,
                 count(*) FILTER (WHERE NOT held AND event_id % 5 = 0)
                 + count(*) FILTER (WHERE NOT held AND event_id % 7 = 0 AND own < 3) AS repeated FROM marked)
    SELECT kept + late + repeated AS rows_in, kept AS rows_kept, repeated AS rows_repeated, late AS rows_late,
           0::BIGINT AS rows_untimed FROM n""")
def stream_dedup_report(spark, sf_dir):
    report = _deduplicated(spark, sf_dir)[1]
    names = ["rows_in", "rows_kept", "rows_repeated", "rows_late", "rows_untimed"]
    return spark.createDataFrame([tuple(getattr(report, name) for name in names)],
                                 ", ".join(f"{name} bigint" for name in names))


@query(f"""
    WITH {SPOILED_SQL},
    placed AS (
        SELECT event_type, date_trunc('month', ts) + INTERVAL 10 DAY * least(2, (day(ts) - 1) // 10) AS period, v FROM spoiled),
    known AS (
        SELECT *, row_number() OVER (PARTITION BY event_type, period ORDER BY v) AS r,
               count(*) OVER (PARTITION BY event_type, period) AS n, min(period) OVER (PARTITION BY event_type) AS base
        FROM placed WHERE v IS NOT NULL),
    edges AS (
        SELECT event_type, i, min(v) AS edge FROM known, range(1, 10) AS cut (i)
        WHERE period = base AND r >= ceil(round(n * i / 10, 6)) GROUP BY ALL),
    groups AS (SELECT DISTINCT event_type, period, n, base FROM known),
    ranks AS (
        SELECT g.event_type, g.period, g.n, g.base, e.i,
               (count(*) FILTER (WHERE k.v <= e.edge) * {sketches.RANK_STEPS} // g.n) / {sketches.RANK_STEPS}.0 AS rank
        FROM groups AS g JOIN edges AS e ON e.event_type IS NOT DISTINCT FROM g.event_type
        JOIN known AS k ON k.event_type IS NOT DISTINCT FROM g.event_type AND k.period = g.period
        GROUP BY g.event_type, g.period, g.n, g.base, e.i
        UNION ALL SELECT event_type, period, n, base, 10, 1.0 FROM groups),
    shares AS (
        SELECT event_type, period, n, base, i, greatest(rank - coalesce(lag(rank) OVER (
            PARTITION BY event_type, period ORDER BY i), 0), 1e-4)::DOUBLE AS share FROM ranks)
    SELECT s.period, s.event_type AS key, s.n AS n_values, round(sum((s.share - r.share) * ln(s.share / r.share)), 6) AS psi
    FROM shares AS s JOIN shares AS r ON r.event_type IS NOT DISTINCT FROM s.event_type AND r.period = r.base AND r.i = s.i
    GROUP BY ALL""")
def drift_quantiles(spark, sf_dir):
    """Ten days against the first ten, by bins from the sketches of three runs. The sketches
    are exact on the tables that this is compared on, as their size exceeds the groups."""
    path, rows = work_dir(spark, "quantiles"), spoiled(spark, sf_dir)
    third = F.least(F.lit(2), F.floor((F.day("ts") - 1) / 10)).cast("int")
    period = (F.date_trunc("month", "ts") + F.make_dt_interval(days=third * 10)).cast("timestamp_ntz")
    for run in range(3):
        part = rows.where(F.col("event_id") % 3 == run)
        append_run(sketches.quantile_sketches(part, period, "event_type", "value", 65535), path, f"run-{run}")
    found = sketches.quantile_stability(sketches.merged_quantiles(read_runs(spark, path)))
    return _rounded(found.select("period", "key", "n_values", "psi"), 6, "psi")


@query(f"""
    WITH {SPOILED_SQL}
    SELECT 'event_type' AS column_name, count(*) AS n_rows, count(*) - count(event_type) AS n_missing,
           count(DISTINCT event_type) AS n_distinct, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS listed,
           true AS within FROM spoiled
    UNION ALL SELECT 'user_id', count(*), 0, NULL, NULL, true FROM spoiled
    UNION ALL SELECT 'value', count(*), count(*) - count(v), NULL, NULL, true FROM spoiled
    UNION ALL SELECT 'event_id', count(*), 0, NULL, NULL, true FROM spoiled""")
def distinct_sketch(spark, sf_dir):
    """Columns of few and of many values, over three runs; estimates against exact counts."""
    path, names = work_dir(spark, "distinct"), ["event_type", "user_id", "value", "event_id"]
    rows = spoiled(spark, sf_dir)
    for run in range(3):
        append_run(sketches.distinct_sketches(rows.where(F.col("event_id") % 3 == run), names, listed=10), path, f"run-{run}")
    merged = sketches.merged_distincts(read_runs(spark, path), listed=10)
    exact = rows.agg(*[F.count_distinct(F.nanvl(F.col(c), F.lit(None)) if c == "value" else F.col(c)).alias(c)
                       for c in names])
    true = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("truth")) for c in names])))
    near = F.abs(F.col("n_distinct") - F.col("truth")) <= F.ceil(F.col("truth") * sketches.DISTINCT_ERROR)
    return merged.join(true, F.col("column_name") == F.col("name")).select(
        "column_name", "n_rows", "n_missing", F.when(F.col("values").isNotNull(), F.col("n_distinct")).alias("n_distinct"),
        F.array_join("values", ",").alias("listed"), near.alias("within"))


# Messages whose fields change by the hour, beside what is expected of them.
FIELD_CONTRACT = {"coin": Column("string"), "usd": Column("float"), "eur": Column("float"), "volume": Column("int")}

FIELD_MESSAGE = {
    "coin": "',\"coin\":\"' || event_type || '\"'",
    "usd": "',\"usd\":' || CASE WHEN h % 6 = 5 AND event_id % 10 = 0 THEN '\"x\"' WHEN event_id % 2 = 0 "
           "THEN event_id || '' ELSE event_id || '.5' END",
    "eur": "CASE WHEN h % 8 <> 3 THEN ',\"eur\":' || event_id || '.25' ELSE '' END",
    "venue": "CASE WHEN h % 12 = 7 THEN ',\"venue\":{\"id\":1}' ELSE '' END",
    "note": "CASE WHEN event_id % 50 = 0 THEN ',\"note\":null' ELSE '' END",
}
FIELD_TEXT = ("CASE WHEN event_id % 97 = 0 THEN '#' ELSE '{' || substr(" + " || ".join(FIELD_MESSAGE.values()) + ", 2) || '}' END")


@query(f"""
    WITH texts AS (
        SELECT date_trunc('hour', ts) AS period, {FIELD_TEXT} AS text FROM (SELECT *, hour(ts)::BIGINT AS h FROM events)),
    objects AS (SELECT period, text::JSON AS doc FROM texts WHERE json_valid(text)),
    parts AS (SELECT period, field, json_type(doc, '$.' || field) AS t
              FROM objects, LATERAL (SELECT unnest(json_keys(doc)) AS field)),
    found AS (
        SELECT period, field, count(*) AS n, list_distinct(list(CASE
            WHEN t IN ('UBIGINT', 'BIGINT') THEN 'int' WHEN t = 'DOUBLE' THEN 'float' WHEN t = 'VARCHAR' THEN 'string'
            ELSE lower(t) END)) AS kinds FROM parts GROUP BY ALL),
    typed AS (
        SELECT period, field, n, CASE WHEN len(kinds) = 1 THEN kinds[1]
            WHEN len(list_filter(kinds, lambda k: k NOT IN ('int', 'float'))) = 0 THEN 'float' ELSE 'mixed' END AS observed
        FROM found),
    expected AS (
        SELECT period, field, expected FROM (SELECT DISTINCT period FROM texts),
               (VALUES ('coin', 'string'), ('usd', 'float'), ('eur', 'float'), ('volume', 'int')) AS c (field, expected))
    SELECT coalesce(typed.period, expected.period) AS period, coalesce(typed.field, expected.field) AS field, expected, observed,
           coalesce(n, 0) AS n_messages,
           CASE WHEN expected IS NULL THEN 'new' WHEN observed IS NULL THEN 'vanished'
                WHEN observed IN (expected, 'null') OR (expected = 'float' AND observed = 'int') THEN 'ok'
                ELSE 'retyped' END AS status
    FROM typed FULL JOIN expected ON typed.period = expected.period AND typed.field = expected.field""")
def message_drift(spark, sf_dir):
    texts = table(spark, sf_dir, "events").withColumn("h", F.hour("ts").cast("bigint")).select(
        "ts", F.expr(FIELD_TEXT).alias("value"))
    found = fields.message_fields(texts, "value", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return fields.field_drift(found, FIELD_CONTRACT)


BARS_SQL = f"""
    WITH {SPOILED_SQL},
    bars AS (
        SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_rows,
               arg_min(v, (ts, event_id)) FILTER (WHERE v IS NOT NULL) AS first_value,
               arg_max(v, (ts, event_id)) FILTER (WHERE v IS NOT NULL) AS last_value,
               min(v) AS low_value, max(v) AS high_value
        FROM spoiled GROUP BY ALL)
    SELECT * FROM bars"""


@query(BARS_SQL)
def hourly_snapshot(spark, sf_dir):
    return rollup.hourly_bars(spoiled(spark, sf_dir), "ts", "event_type", "value",
                              time_order(F.col("ts"), F.col("event_id")))


@query(f"{BARS_SQL} WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM spoiled)")
def hourly_snapshot_stream(spark, sf_dir):
    """By a stream, a file to a batch, rows in no order of time, merged after six batches but
    the last; the bars that are closed."""
    path = work_dir(spark, "bars")
    spoiled(spark, sf_dir).repartition(6).write.parquet(f"{path}/in")
    stored = spark.read.parquet(f"{path}/in")
    stream = parquet_stream(spark, f"{path}/in", stored.schema, max_files=1)
    rollup.start_bars(stream, f"{path}/rows", f"{path}/checkpoint", "ts", "event_type", "value",
                      time_order(F.col("ts"), F.col("event_id"))).awaitTermination()
    kept = rollup.bar_schema(spark, stored.schema, "ts", "event_type", "value", time_order(F.col("ts"), F.col("event_id")))
    rollup.compact_bars(spark, f"{path}/rows", "event_type", kept)
    last = F.lit(stored.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    return rollup.closed_bars(rollup.read_bars(spark, f"{path}/rows", "event_type", kept), last,
                              timedelta(hours=2))
