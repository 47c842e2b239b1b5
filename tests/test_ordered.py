"""Latest rows, ids, running values and late rows against brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stocktide.functions.times import event_time
from stocktide.operators import latest as L
from stocktide.operators import lateness
from stocktide.operators import ordered as N


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Keep small ranges apart, so that the borders between partitions are really crossed."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def skewed(spark, rows=3000):
    """A third of the rows belongs to one key."""
    rng = random.Random(7)
    data = []
    for i in range(rows):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(200)}"
        data.append((i, key, rng.randrange(5000)))
    return data, spark.createDataFrame(data, "id bigint, k string, t bigint").repartition(8)


def test_latest_forms_agree(spark):
    data, df = skewed(spark)
    best = {}
    for i, k, t in data:
        best[k] = max(best.get(k, (-1, -1)), (t, i))
    order = [F.col("t"), F.col("id")]
    for form in (L.latest_per_key, L.latest_by_window):
        assert {r["k"]: (r["t"], r["id"]) for r in form(df, ["k"], order).collect()} == best


def test_latest_by_parsed_time(spark):
    df = spark.createDataFrame([("a", "2026-01-01T00:00:00Z"), ("a", "2026-01-01T00:00:00.5Z")], "k string, e string")
    assert L.latest_per_key(df, ["k"], [event_time(F.col("e"))]).first()["e"].endswith(".5Z")


def test_latest_reduces_before_the_shuffle(spark):
    _, df = skewed(spark)
    plan = L.latest_per_key(df, ["k"], [F.col("t")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") == 1


@pytest.mark.parametrize("first", [1, 1006])
def test_id_forms_agree(spark, first):
    _, df = skewed(spark)
    keys = df.select("k").distinct()
    spread = N.numbered(keys, [F.col("k")], first=first)
    plain = keys.withColumn("id", F.row_number().over(Window.orderBy("k")).cast("bigint") + F.lit(first - 1))
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect()))
    assert "SinglePartition" not in spread._jdf.queryExecution().executedPlan().toString()


def test_ids_of_many_rows(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("k"))
    ids = N.numbered(df, [F.col("k")], first=0)
    assert ids.where("id <> k").count() == 0 and ids.count() == 50_000


def test_ids_of_nothing(spark):
    assert N.numbered(spark.createDataFrame([], "k string"), [F.col("k")]).count() == 0


def test_running_total(spark):
    df = spark.range(10_000).select("id", (F.col("id") % 5).alias("v"))
    got = {r["id"]: r["s"] for r in N.running_total(df, [F.col("id")], "v", "s").collect()}
    total = 0
    for i in range(10_000):
        total += i % 5
        assert got[i] == total


def test_late_rows_of_a_hot_key(spark):
    data, df = skewed(spark)
    rows = df.select(F.col("id").alias("n"), "k", F.timestamp_seconds("t").alias("ts"))
    flags = {r["n"]: r["is_late"] for r in lateness.late_flags(rows, "k", "ts", ["n"], 100).collect()}
    seen, want = {}, {}
    for i, k, t in data:
        want[i] = k in seen and t < seen[k] - 100
        seen[k] = max(seen.get(k, -1), t)
    assert flags == want


def test_running_max_spreads_a_hot_key(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id", (F.col("id") % 1000).alias("t")).repartition(8)
    ranged = N.in_ranges(df, F.col("k"), F.col("id"))
    assert ranged.select("_part").distinct().count() > 1


def test_rows_without_a_key_are_kept(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 1), (3, "a", 5), (4, "a", 1)], "n int, k string, t int")
    rows = df.withColumn("ts", F.timestamp_seconds("t"))
    got = {r["n"]: r["is_late"] for r in lateness.late_flags(rows, "k", "ts", ["n"]).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True}
