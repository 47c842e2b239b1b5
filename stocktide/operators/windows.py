"""Event-time windows over telemetry. stream-safe unless noted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.functions.numeric import given, mean, mean_2dp
from stocktide.functions.times import iso_text
from stocktide.operators.ordered import in_ranges


def _statistics() -> list[Column]:
    """Number of rows and mean reading per window."""
    return [
        F.count(F.lit(1)).alias("reading_count"),
        mean(F.col("temperature")).alias("avg_temperature"),
    ]


def tumbling(df: DataFrame, width: str = C.WINDOW, key: str = "device_id", ts: str = "ts") -> DataFrame:
    """Fixed windows aligned to the epoch."""
    return _flat(df.groupBy(F.window(ts, width).alias("_w"), key).agg(*_statistics()), key)


def sliding(df: DataFrame, width: str = C.WINDOW, step: str = C.SLIDE, key: str = "device_id", ts: str = "ts") -> DataFrame:
    """Overlapping windows: each row counts in width / step of them."""
    return _flat(df.groupBy(F.window(ts, width, step).alias("_w"), key).agg(*_statistics()), key)


def _flat(grouped: DataFrame, key: str) -> DataFrame:
    rest = [c for c in grouped.columns if c not in ("_w", key)]
    return grouped.select(
        key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest
    )


def sessions(df: DataFrame, gap_seconds: int, key: str = "device_id", ts: str = "ts") -> DataFrame:
    """Runs of readings with at most ``gap_seconds`` between neighbours (batch only).

    Readings of one key that fall into the same span of gap length belong to the same
    session anyway, so they are combined before the shuffle. Spans are range partitioned by
    key and time, and a key may cover many partitions: the last reading and the number
    of sessions before a partition come from one summary per (partition, key), so no
    task holds a key. The window end is the last reading plus the gap.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = gap_seconds * 1_000_000
    spans = df.groupBy(key, F.floor(micros / F.lit(gap)).alias("_span")).agg(
        F.min(micros).alias("_first"),
        F.max(micros).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.count(given(F.col("temperature"))).alias("_readings"),
        F.sum(given(F.col("temperature"))).alias("_sum"),
    )
    numbered = running_sessions(spans, key, gap)
    return (
        numbered.groupBy(key, "_session")
        .agg(
            F.timestamp_micros(F.min("_first")).alias("window_start"),
            F.timestamp_micros(F.max("_last") + F.lit(gap)).alias("window_end"),
            F.sum("_n").alias("reading_count"),
            (F.sum("_sum").cast("double") / F.sum("_readings")).alias("avg_temperature"),
        )
        .drop("_session")
    )


def running_sessions(spans: DataFrame, key: str, gap: int) -> DataFrame:
    """Spans (key, _span, _first, _last, ...) with ``_session``: how many sessions of the key have begun up to them."""
    ranged = in_ranges(spans, F.col(key), F.col("_span"))
    parts = Window.partitionBy(key).orderBy("_part")
    ends = ranged.groupBy("_part", key).agg(F.max("_last").alias("_part_last"))
    carried = ends.select("_part", key, F.lag("_part_last").over(parts).alias("_carried")).alias("c")
    same = (F.col("r._part") == F.col("c._part")) & F.col(f"r.{key}").eqNullSafe(F.col(f"c.{key}"))
    placed = ranged.alias("r").join(carried, same, "left").select("r.*", "c._carried")
    inside = Window.partitionBy("_part", key).orderBy("_pos")
    before = F.coalesce(F.lag("_last").over(inside), F.col("_carried"))
    opened = placed.withColumn("_opens", F.coalesce(F.col("_first") - before > gap, F.lit(True)).cast("int"))
    local = opened.withColumn("_session", F.sum("_opens").over(inside))
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    counts = opened.groupBy("_part", key).agg(F.sum("_opens").alias("_begun"))
    begun = counts.select("_part", key, F.coalesce(F.sum("_begun").over(earlier), F.lit(0)).alias("_earlier")).alias("c")
    return local.alias("r").join(begun, same).select(
        *[f"r.{c}" for c in spans.columns], (F.col("r._session") + F.col("c._earlier")).alias("_session")
    )


def sessions_streaming(df: DataFrame, gap: str, key: str = "device_id", ts: str = "ts") -> DataFrame:
    """The same with Spark's session window, whose state lives in the state store."""
    return _flat(df.groupBy(F.session_window(ts, gap).alias("_w"), key).agg(*_statistics()), key)


def device_statistics(df: DataFrame, width: str = C.WINDOW, ts: str = "ts", *more: Column) -> DataFrame:
    """Per device and fixed window: rounded means, number of readings and of errors. A missing humidity gives 0.0."""
    grouped = df.groupBy(F.window(ts, width).alias("_w"), "device_id").agg(
        mean_2dp(F.col("temperature")).alias("avg_temperature"),
        F.coalesce(mean_2dp(F.col("humidity")), F.lit(0.0)).alias("avg_humidity"),
        F.count(F.lit(1)).alias("reading_count"),
        F.count_if(F.col("status") == C.ERROR_STATUS).alias("error_count"),
        *more,
    )
    return _flat(grouped, "device_id")


def device_windows(df: DataFrame, width: str = C.WINDOW, ts: str = "ts", stamped: bool = False) -> DataFrame:
    """Statistics of the windows that have any temperature. ``stamped`` adds the moment of computing."""
    flat = device_statistics(df, width, ts).where(F.col("avg_temperature").isNotNull())
    return flat.withColumn("aggregated_at", F.current_timestamp()) if stamped else flat


def window_messages(windows: DataFrame, zone: str = "") -> DataFrame:
    """Window results as JSON messages with all times as ISO text."""
    times = [c for c in ("window_start", "window_end", "aggregated_at") if c in windows.columns]
    out = windows.withColumns({c: iso_text(F.col(c), zone) for c in times})
    return out.select(F.to_json(F.struct(*out.columns)).cast("binary").alias("value"))


def with_event_time(df: DataFrame, ts: str = "ts", lateness: str = C.ALLOWED_LATENESS) -> DataFrame:
    """Event time and watermark: rows are accepted until the newest seen time minus the
    lateness has passed their window. The watermark moves between micro-batches."""
    if dict(df.dtypes)[ts] != "timestamp":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, lateness)
