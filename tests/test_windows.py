import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stocktide.operators import windows as W
from stocktide.operators.ordered import in_ranges

SCHEMA = "device_id string, ts timestamp, temperature double, humidity double, status string"
T0 = dt.datetime(2026, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_device_windows_rules(spark):
    df = spark.createDataFrame(
        [
            ("a", at(0), 20.0, None, "OK"), ("a", at(59), 21.0, None, "ERROR"), ("a", at(60), 30.0, 50.0, "OK"),
            ("a", at(10), None, None, "ERROR"), ("b", at(5), None, 40.0, "OK"),
        ],
        SCHEMA,
    )
    got = {(r["device_id"], r["window_start"]): tuple(r)[3:] for r in W.device_windows(df).collect()}
    assert got == {("a", at(0)): (20.5, 0.0, 3, 2), ("a", at(60)): (30.0, 50.0, 1, 0)}
    assert "aggregated_at" in W.device_windows(df, stamped=True).columns


def sessions_by_hand(rows, gap):
    out = []
    by_key = {}
    for key, ts in rows:
        by_key.setdefault(key, []).append(ts)
    for key, times in by_key.items():
        times.sort()
        start = last = times[0]
        n = 1
        for ts in times[1:]:
            if (ts - last).total_seconds() <= gap:
                n += 1
            else:
                out.append((key, start, last + dt.timedelta(seconds=gap), n))
                start, n = ts, 1
            last = ts
        out.append((key, start, last + dt.timedelta(seconds=gap), n))
    return sorted(out)


@pytest.mark.parametrize("gap", [1, 60, 600])
def test_sessions_equal_brute_force(spark, gap):
    rng = random.Random(gap)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(9)}", at(rng.randrange(20_000))) for _ in range(1500)]
    df = spark.createDataFrame([(k, t, 1.0, 1.0, "OK") for k, t in rows], SCHEMA)
    got = sorted(tuple(r)[:4] for r in W.sessions(df, gap).select("device_id", "window_start", "window_end", "reading_count").collect())
    assert got == sessions_by_hand(rows, gap)
    plain = W.sessions_streaming(df, f"{gap} seconds").select("device_id", "window_start", "window_end", "reading_count")
    assert sorted(tuple(r) for r in plain.collect()) == got


def test_sessions_of_one_device_over_years(spark):
    """The device's time is cut over many tasks, and sessions that cross a cut stay whole."""
    rng = random.Random(1)
    moments, now = [], 0
    for _ in range(6000):
        now += rng.choice([10, 50, 60, 61, 40_000])
        moments.append(now)
    rows = [("hot", at(s)) for s in moments] + [("cold", at(5)), (None, at(7)), (None, at(9))]
    df = spark.createDataFrame([(k, t, 1.0, 1.0, "OK") for k, t in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = W.sessions(df, 60).select("device_id", "window_start", "window_end", "reading_count").collect()
        spans = df.groupBy("device_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("_span")).count()
        parts = [r["_part"] for r in in_ranges(spans, F.col("device_id"), F.col("_span")).where("device_id = 'hot'").select("_part").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(tuple(r) for r in got if r[0]) == sessions_by_hand([r for r in rows if r[0]], 60)
    assert [tuple(r) for r in got if r[0] is None] == [(None, at(7), at(69), 2)]
    assert max(parts.count(p) for p in set(parts)) < len(parts) / 4


def test_gap_of_exactly_the_limit_continues(spark):
    df = spark.createDataFrame([("a", at(0), 1.0, 1.0, "OK"), ("a", at(60), 1.0, 1.0, "OK")], SCHEMA)
    assert W.sessions(df, 60).count() == 1


def test_sessions_of_times_before_1970(spark):
    early = dt.datetime(1969, 12, 31, 23, 59, 50)
    rows = [("a", early), ("a", early + dt.timedelta(seconds=15)), ("a", early + dt.timedelta(seconds=300))]
    df = spark.createDataFrame([(k, t, 1.0, 1.0, "OK") for k, t in rows], SCHEMA)
    assert W.sessions(df, 60).count() == 2


def test_sliding_counts_rows_in_each_window(spark):
    df = spark.createDataFrame([("a", at(45), 1.0, 1.0, "OK")], SCHEMA)
    assert sorted(r["window_start"] for r in W.sliding(df).collect()) == [at(0), at(30)]


def test_messages(spark):
    df = spark.createDataFrame([("a", at(0), 20.0, 40.0, "OK")], SCHEMA)
    text = bytes(W.window_messages(W.device_windows(df), "Z").first()["value"]).decode()
    assert '"window_start":"2026-01-01T00:00:00Z"' in text and '"reading_count":1' in text
