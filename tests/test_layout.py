import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.functions.times import stable_bucket
from stocktide.operators import evolve as E
from stocktide.operators import history as H
from stocktide.operators import layout as Y
from stocktide.sources import readers as R
from stocktide.sources import writers as O

START = dt.datetime(2026, 1, 1)


def readings(spark, n=2000):
    return spark.range(n).select(
        "id", (F.col("id") % 20).cast("string").alias("device_id"),
        F.timestamp_seconds(F.lit(1767225600) + F.col("id") * 300).alias("ts"),
        F.when(F.col("id") % 10 == 0, "ERROR").otherwise("OK").alias("status"),
    )


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_clustered_table_prunes(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    O.write_clustered(readings(spark), path, F.to_date("ts"), ["device_id"])
    table = spark.read.parquet(path)
    assert same(table.drop("date"), readings(spark))
    pruned = Y.pruning_report(table.where("date = '2026-01-03' and device_id = '3'"))
    assert "date" in pruned["partition_filters"] and "EqualTo(device_id,3)" in pruned["pushed_filters"]
    by_time = Y.pruning_report(table.where("to_date(ts) = '2026-01-03'"))
    assert by_time["partition_filters"] == ""


def test_days_are_replaced_not_added(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = readings(spark).withColumn("date", F.to_date("ts"))
    O.replace_days(rows, path, ["date"])
    O.replace_days(rows, path, ["date"])
    assert spark.read.parquet(path).count() == 2000
    O.replace_days(rows.where("date = '2026-01-02'").limit(1), path, ["date"])
    left = spark.read.parquet(path)
    assert left.where("date = '2026-01-02'").count() == 1
    assert left.count() == 2000 - 288 + 1


def test_compaction(spark, tmp_path):
    source, target = f"file://{tmp_path}/small", f"file://{tmp_path}/big"
    readings(spark).repartition(16).write.parquet(source)
    Y.compact(spark, source, target, [], ["device_id"])
    before, after = spark.read.parquet(source), spark.read.parquet(target)
    assert same(before, after) and len(after.inputFiles()) < len(before.inputFiles())


def test_only_folders_with_small_files_are_rewritten(spark, tmp_path):
    path, rows = f"file://{tmp_path}/t", readings(spark)
    Y.spread_out(rows.where("status = 'OK'"), 12).write.partitionBy("status").parquet(path)
    rows.where("status = 'ERROR'").coalesce(1).write.mode("append").partitionBy("status").parquet(path)
    names = lambda status: sorted(p.name for p in (tmp_path / "t" / f"status={status}").glob("*.parquet"))
    before, kept = names("OK"), names("ERROR")
    size = sum((tmp_path / "t" / "status=OK" / name).stat().st_size for name in before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # pieces this small would share a task
    try:
        done = Y.compact_small(spark, path, rows.schema, ["status"], ["device_id", "ts"], target_bytes=size // 3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [(r["status"], r["small"], r["bytes"]) for r in done.collect()] == [("OK", 12, size)]
    assert names("ERROR") == kept and not set(names("OK")) & set(before) and 2 <= len(names("OK")) <= 4
    assert same(spark.read.schema(rows.schema).parquet(path), rows)
    assert Y.compact_small(spark, path, rows.schema, ["status"], ["ts"], target_bytes=1).isEmpty()


def test_layouts_are_read_together(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    fields = [{}, {"status": F.col("status")}, {"device": stable_bucket(F.col("device_id"), 10)}]
    for part, by in enumerate(fields):
        Y.write_by(readings(spark).where(F.col("id") % 3 == part), f"{path}/{part}", **by)
    assert same(Y.read_together(spark, [f"{path}/{part}" for part in range(3)]), readings(spark))
    files = H.file_inventory(spark, f"{path}/1")
    assert {r["partition"] for r in files.collect()} == {"_by_status=OK", "_by_status=ERROR"}
    assert files.agg(F.sum("record_count")).first()[0] == readings(spark).where("id % 3 = 1").count()


def test_bucket_of_layout_is_the_bucket_function(spark):
    counts = {r["bucket"]: r["rows"] for r in Y.bucket_counts(readings(spark), "device_id").collect()}
    assert sum(counts.values()) == 2000 and set(counts) <= set(range(10))


def test_partition_profile(spark):
    profile = Y.partition_profile(Y.narrowed(Y.spread_out(readings(spark), 8), 2)).collect()
    assert len(profile) == 2 and sum(r["rows"] for r in profile) == 2000


def test_retention(spark):
    rows = readings(spark).withColumn("date", F.to_date("ts"))
    kept = Y.retain_recent(rows, F.lit("2026-01-07"), 2)
    assert kept.agg(F.min("date")).first()[0] == dt.date(2026, 1, 5)


def test_old_days_of_a_table_are_dropped(spark):
    rows = readings(spark).withColumn("date", F.to_date("ts").cast("string"))
    rows.write.mode("overwrite").partitionBy("date").saveAsTable("old_days")
    assert Y.drop_days_before(spark, "old_days", "2026-01-04") == 3
    assert spark.table("old_days").agg(F.min("date")).first()[0] == "2026-01-04"
    O.drop_table(spark, "old_days")


def test_evolution_of_columns(spark, tmp_path):
    old, new, written = (f"file://{tmp_path}/{name}" for name in ("old", "new", "written"))
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(old)
    spark.createDataFrame([(2, "y", "n")], "a int, b string, notes string").write.parquet(new)
    schema = E.with_column(spark.read.parquet(old).schema, "notes", "string", "By hand")

    def listed(df):
        return sorted(tuple(r) for r in df.collect())

    table = E.read_declared(spark, [old, new], schema)
    assert listed(table) == [(1, "x", None), (2, "y", "n")]
    renamed = E.renamed(table, "notes", "remarks", "Updated")
    assert renamed.columns == ["a", "b", "remarks"] and renamed.schema["remarks"].metadata["comment"] == "Updated"
    assert listed(renamed) == [(1, "x", None), (2, "y", "n")]
    kept = E.rewritten_without(spark, [old, new], schema, written, "notes")
    assert listed(E.read_declared(spark, [written], kept)) == [(1, "x"), (2, "y")]
    assert listed(E.read_declared(spark, [written], E.with_column(kept, "notes", "string"))) == [(1, "x", None), (2, "y", None)]
    for wrong in (lambda: E.with_column(schema, "a", "int"), lambda: E.renamed(table, "zzz", "y"), lambda: E.renamed(table, "a", "b")):
        with pytest.raises(KeyError):
            wrong()
    with pytest.raises(KeyError):
        E.rewritten_without(spark, [old], kept, written, "notes")


def test_columns_not_asked_for_are_not_read(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    readings(spark).write.parquet(path)
    rows = E.read_declared(spark, [path], E.with_column(readings(spark).schema, "more", "string"))
    report = Y.pruning_report(rows.select("device_id").where("device_id = '3'"))
    assert report["read_schema"] == "struct<device_id:string>" and "EqualTo(device_id,3)" in report["pushed_filters"]


def test_catalog_table_columns(spark):
    O.create_table(spark, "evolving", "a int, b string")
    E.add_table_column(spark, "evolving", "notes", "string", "Manual notes")
    E.comment_table_column(spark, "evolving", "notes", "Updated")
    listed = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE evolving").collect()}
    assert listed["notes"] == "Updated"
    O.drop_table(spark, "evolving")


def test_tables_and_inserts(spark):
    O.create_schema(spark, "shop")
    for _ in range(2):
        O.create_table(spark, "shop.stats", "device_id string, reading_count bigint, date string", ["date"])
    rows = spark.createDataFrame([("2026-06-10", "sensor_001", 1440)], "date string, device_id string, reading_count bigint")
    O.insert_rows(rows, "shop.stats")
    O.insert_rows(rows, "shop.stats")
    assert spark.table("shop.stats").count() == 2
    for _ in range(2):
        O.replace_table(rows, "shop.report")
    assert spark.table("shop.report").count() == 1
    O.drop_schema(spark, "shop")
    assert not spark.catalog.databaseExists("shop")


def test_csv(spark, tmp_path):
    folder = f"file://{tmp_path}/csv"
    rows = spark.createDataFrame([(3, 20.5, 40.0, "OK"), (4, 21.5, None, "ERROR")], R.SENSOR_SCHEMA)
    O.write_csv(rows, folder)
    assert same(R.read_csv(spark, folder, R.SENSOR_SCHEMA), rows)
    assert dict(R.read_csv(spark, folder).dtypes) == {
        "device_id": "int", "temperature": "double", "humidity": "double", "status": "string",
    }
    external = R.external_csv(spark, "external_readings", folder, R.SENSOR_SCHEMA)
    assert same(external, rows)
    O.drop_table(spark, "external_readings")


def test_write_modes(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    for mode, rows in (("overwrite", 10), ("append", 20), ("overwrite", 10)):
        O.write_table(spark.range(10), path, mode)
        assert spark.read.parquet(path).count() == rows
    with pytest.raises(ValueError):
        O.write_table(spark.range(1), path, "ignore")


def test_shared_view_follows_the_files(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    O.write_table(spark.range(3), path, "overwrite")
    R.shared_view(spark, "shared_rows", path)
    assert spark.table("shared_rows").count() == 3
    O.write_table(spark.range(2), path, "append")
    spark.sql("REFRESH TABLE shared_rows")
    assert spark.table("shared_rows").count() == 5


def test_explore(spark):
    text, rows, count = R.explore(readings(spark), 3)
    assert "device_id" in text and len(rows) == 3 and count == 2000
