"""Grouped statistics.

All of them are built-in aggregates, so rows are combined before the shuffle and a key
that holds a large share of the rows sends one partial row per task. stream-safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.functions.numeric import line_total, mean, mean_2dp, round_2dp, total
from stocktide.functions.times import written_day


def mean_by(df: DataFrame, keys: list[str | Column], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(mean(F.col(value)).alias(name))


def count_and_mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(key).alias("count"), mean_2dp(F.col(value)).alias("avg_rating")
    )


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def mean_of(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.agg(mean(F.col(value)).alias(name))


def device_summary(df: DataFrame) -> DataFrame:
    temperature, humidity = F.col("temperature"), F.col("humidity")
    return df.groupBy("device_id").agg(
        mean_2dp(temperature).alias("avg_temp"),
        round_2dp(F.min(temperature)).alias("min_temp"),
        round_2dp(F.max(temperature)).alias("max_temp"),
        mean_2dp(humidity).alias("avg_humidity"),
    )


def device_daily(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Per device and day: mean temperature and humidity and the number of readings."""
    return df.groupBy("device_id", F.to_date(ts).cast("string").alias("date")).agg(
        mean(F.col("temperature")).alias("avg_temperature"),
        mean(F.col("humidity")).alias("avg_humidity"),
        F.count(F.lit(1)).alias("reading_count"),
    )


def sales_daily(orders: DataFrame) -> DataFrame:
    """Completed orders per written day, store and product."""
    return (
        orders.where(F.col("status") == C.DEFAULT_ORDER_STATUS)
        .groupBy(written_day(F.col("event_time")).alias("date"), "store_id", "product_id")
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("total_quantity"),
            line_total(F.col("quantity"), F.col("price")).alias("total_revenue"),
            F.count("order_id").alias("order_count"),
        )
    )


def store_revenue_by_day(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date", "store_id").agg(
        total(F.col("total_revenue")).alias("daily_revenue"),
        F.sum("total_quantity").alias("units_sold"),
    )


def store_revenue(sales: DataFrame) -> DataFrame:
    """Revenue per store; order it with ``basics.top`` or ``orderBy``."""
    return sales.groupBy("store_id").agg(total(F.col("total_revenue")).alias("revenue"))
