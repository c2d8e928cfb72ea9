"""The views as streaming DataFrames: running totals per key, without expiry.

Buckets are keys made from the data, so a late click just updates its old bucket and there is no
watermark, but for ``closed_activity_view``, where late clicks are given up for a state that ends. Spark combines each micro-batch map-side before it meets the state of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinview.operators.views import activity_by_product, approx_visitors_by_product
from twinview.schema import ACTIVITY_BY_PRODUCT, VIEW_KEYS


def activity_view_stream(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Running action counts per key."""
    return activity_by_product(activity, keys)


def visitor_view_stream(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Running approximate number of visitors per key; the state of a key is one sketch."""
    return approx_visitors_by_product(activity, keys)


def exact_visitors_stream(
    activity: DataFrame, distinct: bool = True, keys: Sequence[str] = VIEW_KEYS
) -> DataFrame:
    """Running exact number of visitors per key; with ``distinct=False`` the number of clicks.

    State is spread by (key, visitor), never a list per key. Streaming deduplication has no
    map-side part; where one visitor may have very many clicks, ``start_expiring_view`` with kind
    "exact" and a limit of None drops repeats before the shuffle.
    """
    if not distinct:
        return activity.groupBy(*keys).agg(F.count("*").alias("unique_visitors"))
    visitors = activity.select(*keys, "visitor").dropDuplicates()
    return visitors.groupBy(*keys).agg(F.count("visitor").alias("unique_visitors"))


def closed_activity_view(activity: DataFrame, delay: str) -> DataFrame:
    """Action counts of the buckets that are closed, each key once (for append output).

    A bucket is closed when a click's bucket begins ``delay`` ("3 hours") after it, or later; its
    state is dropped then. A click of a bucket that was closed before the micro-batch ahead of its own
    is too late and left out, and so is one without a bucket or with one up to 1970. A null product is a key like any other.
    """
    timed = activity.withColumn("bucket_time", F.timestamp_millis("timestamp_hour")).withWatermark("bucket_time", delay)
    closed = activity_by_product(timed.where("bucket_time is not null"), ["product", "bucket_time"])
    return closed.withColumn("timestamp_hour", F.unix_millis("bucket_time")).select(*ACTIVITY_BY_PRODUCT.names)
