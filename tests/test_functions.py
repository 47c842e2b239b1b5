"""Scalar functions one by one."""

import datetime as dt

from pyspark.sql import functions as F

from stocktide.functions import numeric as N
from stocktide.functions import times as T
from stocktide.operators import basics as B
from stocktide.sources import messages as M


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_event_time(spark):
    same = one(spark, T.event_time(F.lit("2026-06-04T12:28:16.123456+00:00")).cast("string"))
    assert same == "2026-06-04 12:28:16.123456"
    assert one(spark, T.event_time(F.lit("2026-01-01T02:00:00+02:00")).cast("string")) == "2026-01-01 00:00:00"
    assert one(spark, T.event_time(F.lit("2026-01-01T00:00:00.5Z")) > T.event_time(F.lit("2026-01-01T00:00:00Z")))
    assert one(spark, T.event_time(F.lit(""))) is None and one(spark, T.event_time(F.lit("soon"))) is None


def test_written_day_keeps_the_written_offset(spark):
    assert one(spark, T.written_day(F.lit("2026-01-01T23:30:00-05:00"))) == "2026-01-01"


def test_iso_text(spark):
    ts = F.lit("2026-01-02 03:04:05").cast("timestamp")
    assert one(spark, T.iso_text(ts)) == "2026-01-02T03:04:05"
    assert one(spark, T.iso_text(ts, "Z")) == "2026-01-02T03:04:05Z"


def test_ago(spark):
    at = F.lit("2026-01-02 00:00:00").cast("timestamp_ntz")
    assert one(spark, T.ago(at, minutes=5)) == dt.datetime(2026, 1, 1, 23, 55)
    assert one(spark, T.ago(at, days=7)) == dt.datetime(2025, 12, 26)


def test_bucket_and_spread(spark):
    rows = spark.range(2000).select(
        T.stable_bucket(F.col("id"), 10).alias("b"),
        F.datediff(F.lit("2026-01-10").cast("date"), T.spread_day(F.lit("2026-01-10").cast("timestamp"), F.col("id"), 5).cast("date")).alias("d"),
    ).collect()
    assert {r["b"] for r in rows} == set(range(10)) and {r["d"] for r in rows} == set(range(6))
    assert one(spark, T.stable_bucket(F.lit(None).cast("string"), 10)) is None


def test_rounding_is_decimal(spark):
    assert one(spark, N.round_2dp(F.lit(2.675))) == 2.68
    assert one(spark, N.round_2dp(F.lit(0.125))) == 0.13
    assert one(spark, N.round_2dp(F.lit(-0.125))) == -0.13


def test_sums_do_not_depend_on_order(spark):
    df = spark.range(10_000).withColumn("x", (F.col("id") % 97) / 100)
    for value in (N.settled(N.total(F.col("x"))), N.total(F.col("x").cast("decimal(18,4)"))):
        a = df.repartition(7).agg(value.alias("s")).first()["s"]
        b = df.orderBy(F.desc("id")).coalesce(1).agg(value.alias("s")).first()["s"]
        assert a == b


def test_means_keep_every_magnitude(spark):
    def mean_of(*values):
        return spark.createDataFrame([(v,) for v in values], "value double").select(N.mean(F.col("value"))).first()[0]

    assert mean_of(1e-7, 3e-7) == 2e-7
    assert mean_of(1e15, 1e15) == 1e15 and mean_of(1e300) == 1e300
    assert mean_of(1.0, float("inf")) == float("inf")
    assert mean_of(None) is None and mean_of(float("nan")) is None
    assert one(spark, N.round_2dp(F.lit(1e15))) == 1e15


def test_readings_that_are_not_finite_are_rejected(spark):
    from stocktide.operators import validate as V

    message = '{"device_id":"a","temperature":"%s","humidity":1,"status":"OK","timestamp":"2026-01-01T00:00:00Z"}'
    rows = [(message % text,) for text in ("nan", "inf", "-Infinity", "1e15", "1e-7")]
    df = spark.createDataFrame(rows, "value string").select(F.col("value").cast("binary").alias("value"))
    for tagged in (V.tag_readings(df), V.tag_telemetry(df)):
        assert sorted(r["temperature"] for r in V.valid(tagged).collect()) == [1e-7, 1e15]
        assert [r["reason"] for r in V.rejected(tagged).select("reason").collect()] == [V.UNUSABLE] * 3


def test_explode_and_outer(spark):
    df = spark.createDataFrame([("a|b",), (None,), ("c",)], "g string")
    assert sorted(r["x"] for r in B.exploded(df, "g", "x").collect()) == ["a", "b", "c"]
    assert B.exploded(df, "g", "x", keep_empty=True).count() == 4


def test_format_line(spark):
    df = spark.createDataFrame([("7", 21.0)], "k string, v double")
    assert B.formatted(df, "k", F.col("v")).first()["line"] == "Device: 7 | AvgTemp: 21.00"


def test_default_filter(spark):
    df = spark.createDataFrame([("80.5",), ("80",), (None,), ("hot",)], "t string")
    assert B.above_with_default(df, "t").count() == 1
    assert B.above_with_default(df, "t", limit=-1.0).count() == 4


def test_encode_skips_bad_rows(spark):
    df = spark.createDataFrame(
        [("1", "20.5", "40", "OK"), ("2", "warm", "40", "OK")], "device_id string, temperature string, humidity string, status string"
    )
    row = M.encode_events(df, F.lit("2026-01-01T00:00:00+00:00")).collect()
    assert len(row) == 1
    assert bytes(row[0]["value"]).decode() == (
        '{"device_id":"1","temperature":20.5,"humidity":40.0,"status":"OK","timestamp":"2026-01-01T00:00:00+00:00"}'
    )
    assert row[0]["attributes"] == {"device_id": "1", "timestamp": "2026-01-01T00:00:00+00:00"}


def test_encode_untyped_rows(spark):
    df = spark.createDataFrame([("1", "20.5")], "device_id string, temperature string")
    assert bytes(M.encode_rows(df).first()["value"]).decode() == '{"device_id":"1","temperature":"20.5"}'


def test_mean_leaves_nan_out_of_both_parts(spark):
    from stocktide.functions import numeric

    rows = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "value double")
    assert rows.select(numeric.mean(F.col("value"))).first()[0] == 2.5


def test_last_header_of_a_name_counts(spark):
    from stocktide.sources import readers

    rows = spark.createDataFrame([([("a", b"1"), ("b", b"2"), ("a", b"3")],), ([],)], "headers array<struct<key:string,value:binary>>")
    got = [r[0] for r in rows.select(readers.last_of_each(F.col("headers"))).collect()]
    assert got == [{"a": "3", "b": "2"}, {}]
