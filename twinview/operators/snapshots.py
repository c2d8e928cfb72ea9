"""The last value per key of a changelog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinview.functions import bucket


def last_per_key(changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Each key's row with the highest ``order``, which must be unique per key.

    An aggregate rather than a ranking window: a key with many changes is combined map-side.
    """
    values = [c for c in changes.columns if c not in (*keys, order)]
    return changes.groupBy(*keys).agg(
        *(F.max_by(c, order).alias(c) for c in values), F.max(order).alias(order)
    )


def last_per_window(
    changes: DataFrame, keys: Sequence[str], time_ms: str, order: str, window_ms: int = 28_000
) -> DataFrame:
    """Each key's last row per time window, with the window's start."""
    windowed = changes.withColumn("window_start", bucket(time_ms, window_ms))
    return last_per_key(windowed, [*keys, "window_start"], order)
