import random

import pytest
from pyspark.sql import functions as F

from stocktide.operators import history as H

SCHEMA = "k string, v int, _version bigint, _op string, _seq bigint"


def log(spark, versions=20, keys=12):
    rng = random.Random(3)
    rows, states, state = [], {0: {}}, {}
    for version in range(1, versions + 1):
        for seq in range(rng.randrange(1, 8)):
            key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
            if rng.random() < 0.3:
                rows.append((key, None, version, "delete", seq))
                state.pop(key, None)
            else:
                value = rng.randrange(100)
                rows.append((key, value, version, "upsert", seq))
                state[key] = value
        states[version] = dict(state)
    return spark.createDataFrame(rows, SCHEMA), states


def state(df):
    return {r["k"]: r["v"] for r in df.collect()}


@pytest.mark.parametrize("version", [1, 7, 20])
def test_state_equals_replay(spark, version):
    changes, states = log(spark)
    assert state(H.as_of_version(changes, ["k"], version)) == states[version]


def test_current_is_the_last_version(spark):
    changes, states = log(spark)
    assert state(H.current(changes, ["k"])) == states[20]


def test_expire_keeps_later_states(spark):
    changes, states = log(spark)
    folded = H.expire(changes, ["k"], 12)
    assert folded.where("_version < 12").count() == 0
    for version in (12, 13, 20):
        assert state(H.as_of_version(folded, ["k"], version)) == states[version]


def test_expire_by_age(spark):
    changes, states = log(spark)
    commits = spark.range(1, 21).select(
        F.col("id").alias("version"), F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("committed_at")
    )
    kept = H.expire_older(changes, commits, ["k"], "2026-01-20 00:00:00")
    assert kept.agg(F.min("_version")).first()[0] >= 12
    for version in (12, 20):
        assert state(H.as_of_version(kept, ["k"], version)) == states[version]
    assert H.expire_older(changes, commits, ["k"], "2026-01-05 00:00:00").count() == changes.count()


@pytest.mark.parametrize(("old", "new"), [(5, 9), (9, 5), (3, 3)])
def test_diff(spark, old, new):
    changes, states = log(spark)
    a, b = states[old], states[new]
    want = {}
    for key in a.keys() | b.keys():
        if key not in a:
            want[key] = "added"
        elif key not in b:
            want[key] = "removed"
    found = {r["k"]: r["change"] for r in H.version_diff(changes, ["k"], old, new).collect()}
    want |= {k: "changed" for k in a.keys() & b.keys() if a[k] != b[k]}
    assert found == want


def test_rollback(spark):
    changes, states = log(spark)
    back = changes.unionByName(H.rollback_changes(changes, ["k"], 20, 6))
    assert state(H.as_of_version(back, ["k"], 21)) == states[6]
    assert state(H.as_of_version(back, ["k"], 20)) == states[20]


def test_times_of_versions(spark):
    rows = [("a", 1, 1, "upsert", 0, 10), ("b", 40, 1, "upsert", 0, 10), ("a", 2, 2, "upsert", 0, 11), ("b", None, 3, "delete", 0, 12)]
    timed = spark.createDataFrame(rows, f"{SCHEMA}, hour int")
    changes = timed.drop("hour")
    commits = H.commit_summary(timed.withColumn("at", F.timestamp_seconds(F.col("hour") * 3600)), "at")
    assert state(H.as_of_time(changes, commits, ["k"], "1970-01-01 11:30:00")) == {"a": 2, "b": 40}
    assert state(H.as_of_time(changes, commits, ["k"], 10 * 3_600_000)) == {"a": 1, "b": 40}
    assert sorted(tuple(r) for r in commits.drop("committed_at").collect()) == [(1, 2, 0), (2, 1, 0), (3, 0, 1)]
    with pytest.raises(ValueError, match="no version"):
        H.version_at(commits, "1970-01-01 09:00:00")
    with pytest.raises(ValueError, match="does not exist"):
        H.check_version(commits, 9)


def test_stored_versions_read_a_base_and_what_came_after(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    changes, states = log(spark)
    H.write_changes(changes, path)
    assert state(H.stored_version(spark, path, changes.schema, ["k"], 7)) == states[7]
    assert H.fold_base(spark, path, changes.schema, ["k"], 6) == changes.where("_version <= 6").count()
    assert H.fold_base(spark, path, changes.schema, ["k"], 15) == changes.where("_version <= 15").count()
    for version in (1, 6, 7, 14, 15, 20):
        assert state(H.stored_version(spark, path, changes.schema, ["k"], version)) == states[version]
    plan = H.stored_version(spark, path, changes.schema, ["k"], 8)._jdf.queryExecution().executedPlan().toString()
    assert "(_version" in plan and "PartitionFilters: [isnotnull(_version" in plan
    base = H.stored_version(spark, path, changes.schema, ["k"], 8)
    assert [H.newest_base(spark, path, v) for v in (5, 6, 14, 15, 99)] == [0, 6, 6, 15, 15]
    assert state(base) == states[8]


def test_a_base_stands_for_folders_that_are_gone(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    changes, states = log(spark)
    H.write_changes(changes, path)
    H.fold_base(spark, path, changes.schema, ["k"], 12)
    H.write_changes(changes.where("_version <= 12").withColumn("v", F.lit(-1)), path)  # no reader looks there any more
    assert state(H.stored_version(spark, path, changes.schema, ["k"], 16)) == states[16]


def test_writing_versions_again_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    changes, states = log(spark)
    H.write_changes(changes.where("_version <= 10"), path)
    H.write_changes(changes.where("_version > 8"), path)
    assert H.read_changes(spark, path, changes.schema).count() == changes.count()
    assert state(H.stored_version(spark, path, changes.schema, ["k"], 20)) == states[20]


def test_reading_a_version_prunes_folders(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    changes, _ = log(spark)
    changes.write.partitionBy("_version").parquet(path)
    plan = H.as_of_version(spark.read.parquet(path), ["k"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_version" in plan


def test_row_keys_of_equal_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 25_000 + [("a", None)] * 3, "k string, v int")
    keyed = H.keyed_rows(df, 4)
    assert keyed.count() == 25_003 and keyed.select("_key").distinct().count() == 25_003
    assert keyed.where("v is null").count() == 3
