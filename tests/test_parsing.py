import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import rows
from millrace.functions.messages import iso_utc, message_json, parse_time
from millrace.operators import parsing

TIME = "2026-01-01T00:00:00.123456+00:00"
AT = dt.datetime(2026, 1, 1, 0, 0, 0, 123456)


def sent(spark, *texts):
    data = [(None if text is None else text.encode(),) for text in texts]
    return spark.createDataFrame(data, "value binary")


@pytest.mark.parametrize("text, expected", [
    ('{"coin":"a","usd":1,"eur":2.5,"timestamp":"%s"}' % TIME, ("a", 1.0, 2.5, AT)),
    ('{"coin":"a","usd":"1.5","timestamp":"%s"}' % TIME, ("a", None, None, AT)),
    ('{"coin":"a","gbp":3}', ("a", None, None, None)),
    ('{"coin":5,"usd":1}', ("5", 1.0, None, None)),
    ('{"coin":"a","timestamp":"2026-01-01T02:00:00.123456+02:00"}', ("a", None, None, AT)),
    ('{"coin":"a","timestamp":"x"}', ("a", None, None, None)),
])
def test_messages_with_a_key_are_kept(spark, text, expected):
    assert rows(parsing.parse_messages(sent(spark, text))) == [expected]


@pytest.mark.parametrize("text", [
    '{"coin":null,"usd":1}', '{"usd":1}', "not json", "", None, '{"coin":"a","usd":',
    '[{"coin":"a"}]'])
def test_messages_without_a_key_are_dropped(spark, text):
    assert rows(parsing.parse_messages(sent(spark, text))) == []


@pytest.mark.parametrize("text, reason", [
    ("not json", "malformed"), ("", "malformed"), (None, "malformed"),
    ('{"coin":"a","usd":', "malformed"), ('[{"coin":"a"}]', "malformed"),
    ('{"usd":1}', "missing_key"), ('{"coin":null}', "missing_key"),
    ('{"coin":"a"}', "bad_timestamp"), ('{"coin":"a","timestamp":"x"}', "bad_timestamp"),
    ('{"coin":"a","usd":"wrong","timestamp":"%s"}' % TIME, None)])
def test_reject_reasons(spark, text, reason):
    row = parsing.sort_messages(sent(spark, text)).first()
    assert row["reject_reason"] == reason
    assert row["raw_value"] == (text if reason else None)


def test_accepted_and_rejected_are_complementary(spark):
    both = parsing.sort_messages(sent(spark, "x", '{"coin":"a","timestamp":"%s"}' % TIME))
    assert rows(parsing.accepted(both)) == [("a", None, None, AT)]
    assert rows(parsing.rejected(both)) == [(None, "x", "malformed")]


def test_a_message_is_parsed_once(spark, folder):
    sent(spark, "x").write.parquet(f"{folder}/m")
    stored = spark.read.parquet(f"{folder}/m")
    for df in (parsing.parse_messages(stored), parsing.accepted(parsing.sort_messages(stored)),
               parsing.rejected(parsing.sort_messages(stored))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        generators = [line for line in plan.splitlines() if "from_json" in line]
        assert len(generators) == 1 and generators[0].count("from_json(") == 1


def test_text_lines_feed_the_same_parser(spark):
    lines = spark.createDataFrame([('{"coin":"a"}',)], "value string")
    assert rows(parsing.parse_messages(lines)) == [("a", None, None, None)]


def test_flatten(spark):
    documents = spark.createDataFrame(
        [('{"bitcoin":{"usd":1,"eur":2},"solana":{"usd":3,"gbp":4},"other":{"usd":5}}', "t"),
         ("broken", "t")], "value string, timestamp string")
    assert rows(parsing.flatten_prices(documents)) == [
        ("bitcoin", 1.0, 2.0, "t"), ("solana", 3.0, None, "t")]
    everything = parsing.flatten_prices(documents, coins=None, currencies=["gbp"])
    assert rows(everything) == [("bitcoin", None, "t"), ("other", None, "t"), ("solana", 4.0, "t")]


def test_messages_keep_nulls_and_microseconds(spark):
    df = spark.createDataFrame([("a", None, AT)], "coin string, usd double, ts timestamp_ntz")
    out = parsing.to_messages(df, F.col("coin"), {
        "coin": F.col("coin"), "usd": F.col("usd"), "timestamp": iso_utc(F.col("ts"))}).first()
    assert tuple(out) == ("a", '{"coin":"a","usd":null,"timestamp":"%s"}' % TIME)


def test_round_trip(spark):
    df = spark.createDataFrame([("a", 0.1, 1e-9, AT)],
                               "coin string, usd double, eur double, ts timestamp_ntz")
    value = message_json({"coin": F.col("coin"), "usd": F.col("usd"), "eur": F.col("eur"),
                          "timestamp": iso_utc(F.col("ts"))})
    back = parsing.parse_messages(df.select(value.cast("binary").alias("value")))
    assert rows(back) == rows(df)


def test_unreadable_time_is_null(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "t string")
    assert rows(df.select(parse_time(F.col("t")))) == [(None,)] * 3


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_mean_the_same_in_any_session_zone(spark, zone):
    texts = ["2026-01-01T00:00:00+00:00", "2026-01-01T02:00:00.5+02:00", "2026-07-01 00:00:00Z",
             "12:00:00", "T07:30", "2026-01-01", "2026-01-01T00:00:00", "2026-02-30T00:00:00Z"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        time = parse_time(F.col("t"))
        got = [tuple(r) for r in df.select(time, iso_utc(time)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[:3] == [(dt.datetime(2026, 1, 1), "2026-01-01T00:00:00.000000+00:00"),
                       (dt.datetime(2026, 1, 1, 0, 0, 0, 500_000), "2026-01-01T00:00:00.500000+00:00"),
                       (dt.datetime(2026, 7, 1), "2026-07-01T00:00:00.000000+00:00")]
    assert got[3:] == [(None, None)] * 5
