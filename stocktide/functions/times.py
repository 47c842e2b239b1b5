"""Event-time parsing, day extraction and reproducible stand-ins for clock and random."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 text of a UTC instant, second precision.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def event_time(text: Column) -> Column:
    """ISO-8601 text to timestamp; ``Z``, offsets and fractions are accepted, junk gives null."""
    return F.try_to_timestamp(text)


def written_day(text: Column) -> Column:
    """Day as written in the text (of the written offset, not of UTC)."""
    return F.substring(text, 1, 10)


def iso_text(ts: Column, zone: str = "") -> Column:
    """Timestamp as ISO text in the session time zone, with an optional zone suffix."""
    return F.concat(F.date_format(ts, ISO_SECONDS), F.lit(zone))


def ago(as_of: Column, days: int = 0, minutes: int = 0) -> Column:
    """``as_of`` minus an interval; the moment is an argument so that results repeat."""
    return as_of - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(minutes), F.lit(0))


def _hash32(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def stable_bucket(key: Column, buckets: int) -> Column:
    """Bucket number from an md5 prefix: the same in every engine and run; null stays null."""
    return F.pmod(_hash32(key), F.lit(buckets)).cast("int")


def spread_day(as_of: Column, key: Column, days: int) -> Column:
    """Spread rows over the last ``days`` days by key instead of by a random number."""
    share = _hash32(key).cast("double") / F.lit(4294967296.0)
    whole = F.round(share * F.lit(days)).cast("int")
    return as_of - F.make_dt_interval(whole, F.lit(0), F.lit(0), F.lit(0))
