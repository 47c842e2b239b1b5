"""What the physical plans must not contain, with broadcasting switched off."""

import pytest

import __spark_entry__ as entry

GLOBAL = {
    "scan_count", "dropped_tables", "date_device_avg", "total_records", "one_device_avg", "dq_revenue", "partition_rows",
}
BATCH = sorted(n for n in entry.queries() if not n.startswith("stream_") and not n.startswith("curated_"))


@pytest.fixture(scope="module")
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, sf_dir, no_broadcast, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    if name not in GLOBAL:  # one row per query: a global aggregate has to end in one task
        assert "SinglePartition" not in plan


def test_pruned_columns_and_pushed_filters(spark, sf_dir):
    from stocktide.operators.layout import pruning_report

    report = pruning_report(entry.queries()["user_avg"](spark, sf_dir))
    assert report["read_schema"] == "struct<l_suppkey:bigint,l_quantity:double>"
    report = pruning_report(entry.queries()["filter_rating"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_quantity,4.0)" in report["pushed_filters"]


@pytest.mark.parametrize("name", ["date_device_avg", "one_device_avg"])
def test_key_filters_reach_the_files(spark, sf_dir, name):
    from stocktide.operators.layout import pruning_report

    report = pruning_report(entry.queries()[name](spark, sf_dir))
    assert "EqualTo(user_id,3)" in report["pushed_filters"]
    assert name == "one_device_avg" or "GreaterThanOrEqual(ts,2024-01-10T00:00)" in report["pushed_filters"]


def test_bucketed_join_shuffles_nothing(spark, sf_dir, no_broadcast):
    plan = entry.queries()["sales_with_stock_bucketed"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    plan = entry.queries()["top_stores"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
