"""Projection, filters, ordering and generators. stream-safe except for ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.functions.numeric import round_2dp


def above_with_default(df: DataFrame, column: str, limit: float = C.HIGH_TEMPERATURE, default: float = 0.0) -> DataFrame:
    """Rows whose value is over the limit; a missing or unreadable value counts as the default."""
    value = F.coalesce(F.col(column).try_cast("double"), F.lit(default))
    return df.where(value > limit)


def on_day(df: DataFrame, day: str, key: str, value: str, day_column: str = "date") -> DataFrame:
    """One key on one day. Filters the stored day column, which prunes partitions."""
    return df.where((F.col(day_column) == F.lit(day).cast("date")) & (F.col(key) == value))


def within_day(ts: str, day: str, kind: str = "timestamp_ntz") -> Column:
    """The day as a range on the stored time, which reaches the files' statistics; a cast of the time would not."""
    first = F.lit(day).cast("date")
    return (F.col(ts) >= first.cast(kind)) & (F.col(ts) < F.date_add(first, 1).cast(kind))


def since(df: DataFrame, day: str, ts: str = "ts", day_column: str | None = "date") -> DataFrame:
    """Rows from a day on: the range on the day column prunes, the range on the time is exact."""
    rows = df.where(F.col(ts) >= F.lit(day).cast(dict(df.dtypes)[ts]))
    return rows.where(F.col(day_column) >= F.lit(day).cast("date")) if day_column else rows


def renamed(df: DataFrame, names: dict[str, str], casts: dict[str, str] | None = None) -> DataFrame:
    """Rename columns, then cast some of them by their new names."""
    out = df.withColumnsRenamed(names)
    return out.withColumns({name: F.col(name).cast(kind) for name, kind in (casts or {}).items()})


def exploded(df: DataFrame, column: str, name: str, separator: str = r"\|", keep_empty: bool = False) -> DataFrame:
    """One row per part of a separated text; ``keep_empty`` keeps rows without any."""
    generator = F.explode_outer if keep_empty else F.explode
    return df.withColumn(name, generator(F.split(column, separator)))


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order that has to be total; planned as a top-k, not as a full sort."""
    return df.orderBy(*order).limit(k)


def formatted(df: DataFrame, key: str, value: Column, name: str = "line", pattern: str = C.DEVICE_REPORT) -> DataFrame:
    """One text line per row; the value is rounded in decimal before printing."""
    return df.select(F.format_string(pattern, F.col(key).cast("string"), round_2dp(value)).alias(name))
