import os

import pytest
from pyspark.sql import functions as F

from stocktide.operators import quality as Q
from stocktide.plans.curated import run_curated

ORDERS = "order_id string, store_id string, product_id string, quantity int, price double, customer_id string, event_time string, status string"
STOCK = "store_id string, product_id string, quantity_on_hand int, event_time string, supplier_id string, seq bigint"
PEOPLE = "customer_id string, first_name string, last_name string, email string, phone string, loyalty_tier string, event_time string, seq bigint"
DAY1, DAY2 = "2026-06-10T08:00:00Z", "2026-06-11T08:00:00Z"


@pytest.fixture
def prefix(spark, tmp_path):
    name = "".join(c if c.isalnum() else "_" for c in f"t{tmp_path.name}_").lower()
    yield name
    for table in ("customer_360", "product_performance", "daily_store_revenue"):
        spark.sql(f"DROP TABLE IF EXISTS {name}{table}")


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDERS)


def tables(spark, price=2.5):
    return (
        orders(
            spark, ("1", "s", "p", 2, price, "c", DAY1, "COMPLETED"), ("2", "s", "p", 1, price, "c", DAY2, "COMPLETED"),
            ("3", "s", "p", 9, price, "c", DAY2, "RETURNED"),
        ),
        spark.createDataFrame([("s", "p", 5, DAY1, "x", 1), ("s", "p", 7, DAY2, "x", 2)], STOCK),
        spark.createDataFrame([("c", "A", "B", "e", "1", "GOLD", DAY1, 1), ("c", "A", "B", "e", "1", "SILVER", DAY2, 2)], PEOPLE),
    )


def snapshot(done):
    return [sorted(map(tuple, df.collect())) for df in (done.sales_daily, done.inventory_by_store, done.customer_360, done.product_performance, done.daily_store_revenue)]


def test_run_and_rerun(spark, tmp_path, prefix):
    root = f"file://{tmp_path}/lake"
    first = snapshot(run_curated(spark, *tables(spark), root, ["seq"], prefix=prefix))
    assert first[0] == [("2026-06-10", "s", "p", 2, 5.0, 1), ("2026-06-11", "s", "p", 1, 2.5, 1)]
    assert first[1] == [("s", "p", 7, DAY2, "x")]
    assert first[2] == [("c", "A", "B", "e", "1", "SILVER", DAY2)]
    assert first[3] == [("p", 3, 7.5, 14)]
    assert sorted(r[-2:] for r in first[4]) == [(2.5, 1), (5.0, 2)]
    assert snapshot(run_curated(spark, *tables(spark), root, ["seq"], prefix=prefix)) == first


def test_next_day_keeps_earlier_days_and_updates_stock(spark, tmp_path, prefix):
    root = f"file://{tmp_path}/lake"
    run_curated(spark, *tables(spark), root, ["seq"], prefix=prefix)
    later = "2026-06-12T08:00:00Z"
    done = run_curated(
        spark, orders(spark, ("4", "s", "q", 1, 1.0, "c", later, "COMPLETED")),
        spark.createDataFrame([("s", "p", 1, later, "y", 3), ("t", "p", 2, later, "y", 4)], STOCK),
        spark.createDataFrame([("d", "N", "M", "e", "", "GOLD", later, 3)], PEOPLE), root, ["seq"], prefix=prefix,
    )
    assert done.sales_daily.count() == 3 and done.customer_360.count() == 2
    assert sorted(map(tuple, done.inventory_by_store.collect())) == [("s", "p", 1, later, "y"), ("t", "p", 2, later, "y")]
    assert spark.table(f"{prefix}customer_360").count() == 2


def test_only_stores_with_news_are_rewritten(spark, tmp_path, prefix):
    root = f"file://{tmp_path}/lake"
    inputs = tables(spark)
    stock = inputs[1].unionByName(spark.createDataFrame([("t", "p", 2, DAY1, "x", 3)], STOCK))
    run_curated(spark, inputs[0], stock, inputs[2], root, ["seq"], prefix=prefix)
    files = lambda store: sorted(os.listdir(tmp_path / "lake" / "inventory_by_store" / f"store_id={store}"))
    before = files("s"), files("t")
    news = spark.createDataFrame([("t", "p", 9, DAY2, "x", 4)], STOCK)
    done = run_curated(spark, inputs[0].limit(0), news, inputs[2], root, ["seq"], prefix=prefix)
    assert files("s") == before[0] and files("t") != before[1]
    assert sorted(r["quantity_on_hand"] for r in done.inventory_by_store.collect()) == [7, 9]
    assert done.sales_daily.count() == 2 and done.product_performance.first()["quantity_in_stock"] == 14


def test_many_stores_lie_in_a_bounded_number_of_folders(spark, tmp_path, prefix):
    root = f"file://{tmp_path}/lake"
    sold, _, people = tables(spark)
    stock = spark.range(300).selectExpr(
        "concat('s', id) AS store_id", "'p' AS product_id", "int(id) AS quantity_on_hand", f"'{DAY1}' AS event_time", "'x' AS supplier_id", "id AS seq"
    )
    run_curated(spark, sold, stock, people, root, ["seq"], prefix=prefix, stock_by="store_group")
    folder = tmp_path / "lake" / "inventory_by_store"
    files = {f.name: sorted(os.listdir(f)) for f in folder.glob("store_group=*")}
    assert 1 < len(files) <= 64
    news = spark.createDataFrame([("s7", "p", 1000, DAY2, "y", 900), ("new", "p", 2000, DAY2, "y", 901)], STOCK)
    done = run_curated(spark, sold.limit(0), news, people, root, ["seq"], prefix=prefix, stock_by="store_group")
    want = {(f"s{i}", "p", i, DAY1, "x") for i in range(300) if i != 7} | {("s7", "p", 1000, DAY2, "y"), ("new", "p", 2000, DAY2, "y")}
    got = list(map(tuple, done.inventory_by_store.collect()))
    assert len(got) == 301 and set(got) == want
    now = {f.name: sorted(os.listdir(f)) for f in folder.glob("store_group=*")}
    assert 1 <= sum(now[name] != files.get(name) for name in now) <= 2  # only the groups of the two stores


@pytest.mark.parametrize("bad", ["price", "stock", "customer"])
def test_a_broken_rule_leaves_all_tables_as_they_were(spark, tmp_path, prefix, bad):
    root = f"file://{tmp_path}/lake"
    done = run_curated(spark, *tables(spark), root, ["seq"], prefix=prefix)
    first = snapshot(done)
    sold, stock, people = tables(spark, price=-1.0 if bad == "price" else 9.0)
    if bad == "stock":
        stock = stock.withColumn("quantity_on_hand", F.lit(-4))
    if bad == "customer":
        people = people.unionByName(people.withColumn("customer_id", F.lit(None).cast("string")))
    with pytest.raises(Exception, match="negative|key is null"):
        run_curated(spark, sold, stock, people, root, ["seq"], prefix=prefix)
    now = [done.sales_daily, done.inventory_by_store] + [spark.table(prefix + t) for t in ("customer_360", "product_performance", "daily_store_revenue")]
    assert [sorted(map(tuple, df.collect())) for df in now] == first


def test_a_broken_first_run_publishes_nothing(spark, tmp_path, prefix):
    with pytest.raises(Q.QualityError, match="daily_store_revenue: daily_revenue_not_negative, 2 rows"):
        run_curated(spark, *tables(spark, price=-1.0), f"file://{tmp_path}/lake", ["seq"], prefix=prefix)
    assert not spark.catalog.tableExists(f"{prefix}customer_360") and not (tmp_path / "lake" / "sales_daily").exists()


def test_rules(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "daily_revenue double")
    counts = {r["rule"]: (r["bad_rows"], r["passed"]) for r in Q.rule_counts(df, {**Q.revenue_rules(), "known": F.col("daily_revenue").isNull()}).collect()}
    assert counts == {"daily_revenue_not_negative": (1, False), "known": (1, False)}
    with pytest.raises(Exception, match="too low"):
        Q.asserted(df, F.col("daily_revenue") < 0, "too low").count()
    assert Q.asserted(df, F.col("daily_revenue") > 5, "x").count() == 3
