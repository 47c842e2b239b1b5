import pytest
from pyspark.sql import functions as F

from stocktide.operators import curation as U
from stocktide.operators import upsert as D

TARGET = "k string, v int, t int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, data, schema=TARGET):
    return spark.createDataFrame(data, schema)


FIELDS = {"v": "v", "t": "t"}


def test_matched_unmatched_and_null_target_key(spark):
    target = table(spark, [("a", 1, 1), ("b", 2, 1), (None, 9, 1)])
    source = table(spark, [("b", 20, 2), ("c", 30, 2)])
    assert rows(D.merge(target, source, ["k"], FIELDS)) == [("a", 1, 1), ("b", 20, 2), ("c", 30, 2), (None, 9, 1)]


def test_one_source_row_updates_all_its_target_rows(spark):
    target = table(spark, [("a", 1, 1), ("a", 2, 1)])
    assert rows(D.merge(target, table(spark, [("a", 5, 2)]), ["k"], FIELDS)) == [("a", 5, 2), ("a", 5, 2)]


def test_merge_twice_is_merge_once(spark):
    target, source = table(spark, [("a", 1, 1)]), table(spark, [("a", 2, 2), ("b", 3, 2)])
    once = D.merge(target, source, ["k"], FIELDS)
    assert rows(D.merge(once, source, ["k"], FIELDS)) == rows(once)


def test_repeated_source_key_fails(spark):
    with pytest.raises(Exception, match="occurs twice"):
        D.merge(table(spark, []), table(spark, [("a", 1, 1), ("a", 2, 1)]), ["k"], FIELDS).collect()


def test_null_source_key_fails(spark):
    with pytest.raises(Exception, match="key is null"):
        D.merge(table(spark, [("a", 1, 1)]), table(spark, [(None, 1, 1)]), ["k"], FIELDS).collect()


def test_null_values_are_written(spark):
    merged = D.merge(table(spark, [("a", 1, 1)]), table(spark, [("a", None, 2)]), ["k"], FIELDS)
    assert rows(merged) == [("a", None, 2)]


def test_guarded_merge_ignores_older_rows(spark):
    target = table(spark, [("a", 1, 5), ("b", 1, 5), ("c", 1, None)])
    source = table(spark, [("a", 2, 4), ("b", 2, 6), ("c", 2, 1), ("d", 2, 1)])
    merged = D.merge(target, source, ["k"], FIELDS, newer=("t", "t"))
    assert rows(merged) == [("a", 1, 5), ("b", 2, 6), ("c", 2, 1), ("d", 2, 1)]


def test_branches(spark):
    target, source = table(spark, [("a", 1, 1), ("a", 2, 1)]), table(spark, [("a", 5, 2), ("b", 6, 2)])
    assert rows(D.matched(source, target, ["k"])) == [("a", 5, 2)]
    assert rows(D.not_matched(source, target, ["k"])) == [("b", 6, 2)]


def test_null_predicates_touch_nothing(spark):
    df = table(spark, [("a", 1, 1), ("b", None, 1)])
    assert rows(D.update_where(df, F.col("v") > 0, {"t": F.lit(7)})) == [("a", 1, 7), ("b", None, 1)]
    assert rows(D.delete_where(df, F.col("v") > 0)) == [("b", None, 1)]
    assert rows(D.delete_where(df, F.lit(True))) == []


def test_stock_counts_once_or_per_day(spark):
    sales = spark.createDataFrame(
        [("d1", "s", "p", 1, 1.0, 1), ("d2", "s", "p", 2, 2.0, 1), ("d1", "t", "p", 3, 3.0, 1)], U.SALES_COLUMNS
    )
    stock = spark.createDataFrame([("s", "p", 10, "x", "y")], U.INVENTORY_COLUMNS)
    assert rows(U.product_performance(sales, stock)) == [("p", 6, 6.0, 20)]
    assert rows(U.product_performance(sales, stock, stock_once=True)) == [("p", 6, 6.0, 10)]


def test_native_merge_is_well_formed(spark):
    """Parquet tables refuse row-level changes, but only after the statement was understood."""
    spark.sql("CREATE TABLE IF NOT EXISTS native_target (k string, v int) USING parquet")
    table(spark, [("a", 1, 1)]).createOrReplaceTempView("native_source")
    with pytest.raises(Exception, match="UNSUPPORTED|not supported") as caught:
        D.merge_sql(spark, "native_target", "native_source", ["k"], {"v": "v"}, {"k": "k", "v": "v"})
    assert "PARSE" not in str(caught.value)
    spark.sql("DROP TABLE native_target")


def test_merge_keeps_a_hot_target_key_out_of_full_joins(spark):
    plan = D.merge(table(spark, [("a", 1, 1)]), table(spark, [("a", 1, 1)]), ["k"], FIELDS)
    assert "FullOuter" not in plan._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("newer", [None, ("t", "t")])
def test_both_plans_of_a_merge_agree(spark, newer):
    target = table(spark, [("a", 1, 1), ("b", 2, 5), ("c", None, 1), (None, 9, 1), (None, 8, 1), ("d", 4, 1), ("d", 5, 3)])
    source = table(spark, [("a", 10, 2), ("b", 20, 4), ("c", 30, None), ("d", 40, 2), ("e", None, 7)])
    by_name = [D.merge(target, source, ["k"], FIELDS, newer=newer, target_is_unique=unique) for unique in (False, True)]
    assert sorted(map(repr, by_name[0].collect())) == sorted(map(repr, by_name[1].collect()))
    renamed = [D.merge(target, source, ["k"], {"v": "t"}, {"k": "k", "v": "v"}, target_is_unique=unique) for unique in (False, True)]
    assert sorted(map(repr, renamed[0].collect())) == sorted(map(repr, renamed[1].collect()))


@pytest.mark.parametrize("name", ["merge_inventory", "merge_guarded", "merge_customer"])
def test_merge_reads_each_side_once(spark, sf_dir, name):
    from stocktide.plans import catalog

    plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    big = "o_orderkey" if name == "merge_customer" else "l_orderkey"
    assert sum(1 for line in plan.splitlines() if "FileScan" in line and big in line) == 2


def test_inventory_merge_fails_on_a_null_key(spark):
    from pyspark.errors import PySparkException

    from stocktide.operators.curation import merge_inventory

    schema = "store_id string, product_id string, quantity_on_hand int, last_updated string, supplier_id string"
    target = spark.createDataFrame([("1", "2", 3, "2026-01-01T00:00:00Z", "s")], schema)
    update = spark.createDataFrame([(None, "2", 5, "2026-01-02T00:00:00Z", "s")], schema.replace("last_updated", "event_time"))
    with pytest.raises(PySparkException, match="null"):
        merge_inventory(target, update).collect()
