"""Time buckets and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


def bucket(ms: Column | str, size_ms: int = HOUR_MS) -> Column:
    """Start of the bucket an epoch-ms value falls in; truncates toward zero."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    size = F.lit(size_ms).cast("long")
    return F.call_function("div", ms, size) * size


def bucket_label(ms: Column | str, pattern: str = "MM-dd HH:mm:00", zone: str | None = None) -> Column:
    """Text label of an epoch-ms bucket, in ``zone`` or else the session's time zone."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    instant = F.timestamp_millis(ms)
    if zone is None:
        return F.date_format(instant, pattern)
    wall_clock = F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))
    return F.date_format(wall_clock, pattern)
