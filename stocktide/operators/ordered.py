"""Operators that need a global or per-key order over data of any size.

A window without partition keys moves everything into one task. Instead rows are range
partitioned, sorted inside the partitions and pinned with a reliable checkpoint; then one
summary per partition carries the state over the partition borders.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.session import pin

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def in_ranges(df: DataFrame, *order: Column) -> DataFrame:
    """Range partition by a unique order and tag rows with ``_part`` and ``_pos`` (from 0)."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = pin(placed.withColumn("_mid", F.monotonically_increasing_id()))
    return tagged.select(
        *df.columns,
        F.shiftright("_mid", _ROW_BITS).cast("int").alias("_part"),
        F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1).alias("_pos"),
    )


def _starts(ranged: DataFrame, amount: Column, first: int) -> DataFrame:
    """What all partitions before each one add up to. One number per partition reaches the
    driver and goes back as a broadcast."""
    amounts = sorted(ranged.groupBy("_part").agg(amount.alias("n")).collect())
    starts = accumulate((row["n"] for row in amounts), initial=first)
    rows = [(row["_part"], start) for row, start in zip(amounts, starts)]
    return F.broadcast(ranged.sparkSession.createDataFrame(rows, "_part int, _start bigint"))


def numbered(df: DataFrame, order: list[Column], name: str = "id", first: int = C.FIRST_NUMBERED_ID) -> DataFrame:
    """Consecutive ids in the given order, which has to be unique; one range shuffle."""
    ranged = in_ranges(df, *order)
    return (
        ranged.join(_starts(ranged, F.count(F.lit(1)), first), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_part", "_pos", "_start")
    )


def running_max(df: DataFrame, key: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Greatest value of all earlier rows of the same key; ``order`` has to be unique. A row
    without a key has no earlier rows.

    A key may span many partitions: the maximum before a partition comes from the
    (partition, key) summaries, the maximum inside from a window over (partition, key),
    so no task holds more than one range of rows.
    """
    ranged = in_ranges(df, F.col(key), *order)
    summaries = ranged.groupBy("_part", key).agg(F.max(value).alias("_peak"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = summaries.select("_part", key, F.max("_peak").over(before).alias("_carried"))
    inside = (
        Window.partitionBy("_part", key).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn("_local", F.max(value).over(inside))
    seen = F.when(F.col(key).isNotNull(), F.greatest("_local", "_carried"))
    return local.join(carried, ["_part", key], "left").select(*df.columns, seen.alias(name))


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Running sum over the whole table in a unique order, without a one-task window."""
    ranged = in_ranges(df, *order)
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_inside", F.sum(value).over(inside))
        .join(_starts(ranged, F.coalesce(F.sum(value), F.lit(0)), 0), "_part")
        .withColumn(name, F.col("_start") + F.coalesce("_inside", F.lit(0)))
        .drop("_part", "_pos", "_start", "_inside")
    )
