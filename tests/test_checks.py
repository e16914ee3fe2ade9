"""Each data-quality check against rows that break it, and rows that don't."""

import datetime as dt

from touchpath.operators import checks as Q

T4 = "session_id string, channel_group string, last_event_timestamp timestamp_ntz, f_converted int"


def t4(spark, *rows):
    return spark.createDataFrame([(s, c, dt.datetime(2024, 1, *when), f) for s, c, when, f in rows], T4)


def test_null_channel(spark):
    df = t4(spark, ("a", "Direct", (1, 5), 0), ("b", None, (1, 5), 0), ("b", None, (1, 6), 0), ("c", "SMS", (1, 5), 0))
    assert [r["session_id"] for r in Q.check_null_channel(df).collect()] == ["b"]
    assert Q.check_null_channel(df.where("session_id <> 'b'")).count() == 0


def test_session_over_midnight(spark):
    df = t4(spark, ("a", "Direct", (1, 23), 0), ("a", "Email", (2, 0), 0), ("b", "Direct", (1, 0), 0), ("b", "Email", (1, 23), 0))
    assert [tuple(r) for r in Q.check_session_dates(df).collect()] == [("a", 2)]


def test_session_with_two_flags(spark):
    df = t4(spark, ("a", "Direct", (1, 23), 0), ("a", "Email", (1, 23), 1), ("b", "Direct", (1, 0), 1), ("b", "Email", (1, 23), 1))
    assert [tuple(r) for r in Q.check_session_flags(df).collect()] == [("a", 2)]


def test_duplicate_conversion_ids(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "conversion_id string")
    for check in (Q.check_merge_unique, Q.check_concat_unique):
        assert [tuple(r) for r in check(df).collect()] == [("x", 2)]
        assert check(df.distinct()).count() == 0


def test_null_channel_shows_before_the_lookback_drops_it(spark):
    """Q1 has something to find on touchpoints that no channel filter has passed."""
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    from touchpath.plans import registry as R
    t3 = R.t3(spark, SF_SMALL)
    broken = t3.withColumn("channel_group", F.when(F.col("channel_group") != "SMS", F.col("channel_group")))
    want = {r[0] for r in t3.where("channel_group = 'SMS'").select("session_id").distinct().collect()}
    assert want and {r[0] for r in Q.check_null_channel(broken).collect()} == want
