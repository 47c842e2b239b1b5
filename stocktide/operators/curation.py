"""The curated retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions.times import event_time
from stocktide.operators.latest import latest_per_key
from stocktide.operators.upsert import merge

INVENTORY_COLUMNS = "store_id string, product_id string, quantity_on_hand int, last_updated string, supplier_id string"
CUSTOMER_COLUMNS = (
    "customer_id string, first_name string, last_name string, email string, phone string, "
    "loyalty_tier string, last_updated_time string"
)
SALES_COLUMNS = (
    "date string, store_id string, product_id string, total_quantity bigint, total_revenue double, "
    "order_count bigint"
)
PRODUCT_COLUMNS = "product_id string, total_units_sold bigint, total_revenue double, quantity_in_stock bigint"


def latest_inventory(events: DataFrame, tie: list[str]) -> DataFrame:
    """Newest stock event per store and product, by parsed time and then the tie columns."""
    return latest_per_key(events, ["store_id", "product_id"], [event_time(F.col("event_time")), *map(F.col, tie)])


def latest_customers(events: DataFrame, tie: list[str]) -> DataFrame:
    return latest_per_key(events, ["customer_id"], [event_time(F.col("event_time")), *map(F.col, tie)])


def merge_inventory(target: DataFrame, updates: DataFrame, guarded: bool = False) -> DataFrame:
    """Upsert newest stock events, which hold one row per key."""
    updates = updates.withColumn("_at", event_time(F.col("event_time"))) if guarded else updates
    fields = {"quantity_on_hand": "quantity_on_hand", "last_updated": "event_time", "supplier_id": "supplier_id"}
    if not guarded:
        return merge(target, updates, ["store_id", "product_id"], fields, source_is_unique=True, target_is_unique=True)
    timed = target.withColumn("_at", event_time(F.col("last_updated")))
    merged = merge(
        timed, updates, ["store_id", "product_id"], {**fields, "_at": "_at"}, newer=("_at", "_at"), source_is_unique=True,
        target_is_unique=True,
    )
    return merged.drop("_at")


def merge_customers(target: DataFrame, updates: DataFrame) -> DataFrame:
    names = ["first_name", "last_name", "email", "phone", "loyalty_tier"]
    fields = {**{n: n for n in names}, "last_updated_time": "event_time"}
    return merge(target, updates, ["customer_id"], fields, source_is_unique=True, target_is_unique=True)


def sales_with_stock(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every sales row with the stock of its store and product; unknown stock counts as 0."""
    stock = inventory.select("product_id", "store_id", "quantity_on_hand")
    return sales.join(stock, ["product_id", "store_id"], "left").withColumn(
        "quantity_on_hand", F.coalesce("quantity_on_hand", F.lit(0))
    )


def product_performance(sales: DataFrame, inventory: DataFrame, stock_once: bool = False) -> DataFrame:
    """Units, revenue and stock per product.

    Sales are first reduced to one row per product and store, so the join sees no day
    rows at all. The stock of a store then counts once per sales day, as a join of the
    daily rows would give it, or once per store with ``stock_once``.
    """
    per_store = sales.groupBy("product_id", "store_id").agg(
        F.sum("total_quantity").alias("_units"),
        F.sum("total_revenue").alias("_revenue"),
        F.count(F.lit(1)).alias("_days"),
    )
    joined = sales_with_stock(per_store, inventory)
    times = F.lit(1) if stock_once else F.col("_days")
    return joined.groupBy("product_id").agg(
        F.sum("_units").alias("total_units_sold"),
        F.sum("_revenue").cast("double").alias("total_revenue"),
        F.sum(times * F.col("quantity_on_hand").cast("bigint")).alias("quantity_in_stock"),
    )
