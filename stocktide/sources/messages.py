"""Rows to messages and back. stream-safe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_bytes(*columns: str | Column) -> Column:
    """The given columns as one UTF-8 JSON document."""
    return F.to_json(F.struct(*columns)).cast("binary")


def encode_rows(df: DataFrame) -> DataFrame:
    """Every row as a JSON message, without attributes."""
    return df.select(
        json_bytes(*df.columns).alias("value"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
        F.current_timestamp().alias("publish_time"),
    )


def encode_events(df: DataFrame, stamp: Column) -> DataFrame:
    """Typed sensor messages with device and time as attributes.

    Rows whose temperature or humidity is not a number are left out, as a publisher that
    converts before sending would skip them. ``stamp`` is the ISO text put into every
    message (the moment of sending, or the event's own time when replaying).
    """
    typed = df.select(
        F.col("device_id").cast("string").alias("device_id"),
        F.col("temperature").try_cast("double").alias("temperature"),
        F.col("humidity").try_cast("double").alias("humidity"),
        F.col("status").cast("string").alias("status"),
        stamp.alias("timestamp"),
    ).where(F.col("temperature").isNotNull() & F.col("humidity").isNotNull())
    attributes = F.create_map(
        F.lit("device_id"), F.col("device_id"), F.lit("timestamp"), F.col("timestamp")
    )
    return typed.select(
        json_bytes("device_id", "temperature", "humidity", "status", "timestamp").alias("value"),
        attributes.alias("attributes"),
        F.col("timestamp").try_cast("timestamp").alias("publish_time"),
    )
