"""The nightly curated run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import contracts as C
from stocktide.functions.times import stable_bucket
from stocktide.operators import aggregates, curation, quality
from stocktide.session import staged
from stocktide.sources.writers import balanced, replace_days


@dataclass(frozen=True)
class Curated:
    sales_daily: DataFrame
    inventory_by_store: DataFrame
    customer_360: DataFrame
    product_performance: DataFrame
    daily_store_revenue: DataFrame


def _live(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A table in folders under its declared columns, in their order (folders come last otherwise)."""
    schema = T.StructType.fromDDL(columns)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _switch(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Let a catalog table read another folder. Files of the folder before stay, so open readers go on."""
    if spark.catalog.tableExists(name):
        quoted = path.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
    else:
        spark.catalog.createTable(name, path, "parquet", schema)


def run_curated(
    spark: SparkSession, orders: DataFrame, inventory: DataFrame, customers: DataFrame, root: str,
    tie: list[str], stock_once: bool = False, sales_by: str = "date", prefix: str = "", stock_by: str = "store_id",
) -> Curated:
    """Daily sales, current stock, customer profiles, product performance, store revenue.

    All five are written beside the published ones first, and the job that writes a table counts the rows that
    break its rules. A broken rule in any of them fails the run and leaves all five as they were. Publishing then
    replaces the days (or months, with ``sales_by="month"`` for a long history of thin days) and stores (or groups of
    stores, with ``stock_by="store_group"`` for more stores than a table should have folders) that
    occur in the new rows, each in one job, and lets the other three, catalog tables named with ``prefix``, read their new
    folders. A run that dies while it publishes is healed by running it again: nothing is added twice.
    """
    run = uuid.uuid4().hex
    sales_path, stock_path = f"{root}/sales_daily", f"{root}/inventory_by_store"
    people_name = f"{prefix}customer_360"  # published last, so it tells whether anything was
    started = spark.catalog.tableExists(people_name)
    seen = {}

    def beside(table: str, rows: DataFrame, *folders: str) -> DataFrame:
        rows, seen[table] = quality.watched(rows, quality.CURATED_RULES[table]())
        path = f"{root}/{table}-{run}"
        balanced(rows, *folders).write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    def before(path: str, columns: str) -> DataFrame:
        return _live(spark, path, columns) if started else spark.createDataFrame([], columns)

    daily, sales_columns = aggregates.sales_daily(orders), curation.SALES_COLUMNS
    if sales_by == "month":
        daily, sales_columns = daily.withColumn("month", F.substring("date", 1, 7)), f"{sales_columns}, month string"
    daily = beside("sales_daily", daily, sales_by)
    untouched = before(sales_path, sales_columns).join(daily.select(sales_by).distinct(), sales_by, "left_anti")
    sales = untouched.unionByName(daily)

    news = staged(curation.latest_inventory(inventory, tie), "stock")
    group, stock_columns = {}, curation.INVENTORY_COLUMNS
    if stock_by == "store_group":
        group, stock_columns = {"store_group": stable_bucket(F.col("store_id"), C.STORE_GROUPS)}, f"{stock_columns}, store_group int"
    stores, old_stock = news.withColumns(group).select(stock_by).distinct(), before(stock_path, stock_columns)
    touched = curation.merge_inventory(old_stock.join(stores, stock_by, "left_semi").drop(*group), news)
    touched = beside("inventory_by_store", touched.withColumns(group), stock_by)
    stock = old_stock.join(stores, stock_by, "left_anti").unionByName(touched)

    old_people = spark.table(people_name) if started else spark.createDataFrame([], curation.CUSTOMER_COLUMNS)
    whole = {"customer_360": curation.merge_customers(old_people, curation.latest_customers(customers, tie))}
    whole["product_performance"] = curation.product_performance(sales, stock, stock_once)
    whole["daily_store_revenue"] = aggregates.store_revenue_by_day(sales)
    whole = {table: beside(table, rows) for table, rows in whole.items()}
    quality.require_watched(seen)

    replace_days(daily, sales_path, [sales_by])
    replace_days(touched, stock_path, [stock_by])
    for table in ("product_performance", "daily_store_revenue", "customer_360"):
        _switch(spark, prefix + table, f"{root}/{table}-{run}", whole[table].schema)
    return Curated(
        _live(spark, sales_path, sales_columns), _live(spark, stock_path, curation.INVENTORY_COLUMNS),
        spark.table(people_name), spark.table(f"{prefix}product_performance"), spark.table(f"{prefix}daily_store_revenue"),
    )
