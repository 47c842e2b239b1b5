"""Data-quality rules: one aggregation for all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(Exception):
    """A rule that has to hold does not."""


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: how many rows break it, and whether it passed. ``rules`` hold the
    condition of a bad row."""
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("bad_rows")) for n in rules])
    return counted.select(F.inline(pairs)).withColumn("passed", F.col("bad_rows") == 0)


def require(df: DataFrame, rules: dict[str, Column], message: str) -> None:
    """Fail with the message when any rule is broken; reads one row."""
    broken = [r["rule"] for r in rule_counts(df, rules).where(~F.col("passed")).collect()]
    if broken:
        raise QualityError(f"{message} ({', '.join(broken)})")


def watched(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The same rows, with the bad ones of each rule counted by the job that writes them."""
    seen = Observation()
    return df.observe(seen, *[F.count_if(bad).alias(name) for name, bad in rules.items()]), seen


def require_watched(seen: dict[str, Observation]) -> None:
    """Fail, naming every broken rule of every table, once the tables are written."""
    broken = [f"{table}: {rule}, {n} rows" for table, counts in seen.items() for rule, n in counts.get.items() if n]
    if broken:
        raise QualityError("; ".join(broken))


def asserted(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """The same rows, with the job failing as soon as a task meets a bad one."""
    holds = F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.where(holds)


def revenue_rules() -> dict[str, Column]:
    return {"daily_revenue_not_negative": F.col("daily_revenue") < 0}


def _unknown(*columns: str) -> dict[str, Column]:
    return {f"{c}_known": F.col(c).isNull() for c in columns}


#: What has to hold in each curated table, as conditions of bad rows.
CURATED_RULES = {
    "sales_daily": lambda: {**_unknown("date"), "some_orders": F.col("order_count") < 1},
    "inventory_by_store": lambda: {**_unknown("store_id", "product_id"), "stock_not_negative": F.col("quantity_on_hand") < 0},
    "customer_360": lambda: _unknown("customer_id"),
    "product_performance": lambda: {"stock_not_negative": F.col("quantity_in_stock") < 0},
    "daily_store_revenue": revenue_rules,
}
