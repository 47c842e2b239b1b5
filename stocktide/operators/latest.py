"""Newest row per key and first occurrence per id.

``max(struct(order..., rest...))`` is a partial aggregate: each task sends one row per
key, so a key with a third of all rows does not end up in one task. The remaining
columns take part in the comparison after the order columns, which makes ties
repeatable. The window form is kept for columns that have no order (maps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _extreme(df: DataFrame, keys: list[str], order: list[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("_row"))
    best = df.groupBy(*keys).agg(pick(ranked).alias("_best"))
    return best.select(*[F.col(k) if k in keys else F.col(f"_best._row.{k}").alias(k) for k in df.columns])


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row with the greatest order values per key. Works on batch DataFrames."""
    return _extreme(df, keys, order, F.max)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row with the smallest order values per key: repeats of an event id are dropped."""
    return _extreme(df, keys, order, F.min)


def latest_by_window(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The same by row number; Spark limits groups to one row before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
