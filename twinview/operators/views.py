"""The views: action counts and unique visitors per product and time bucket.

Every aggregate here has a map-side part, so what is shuffled for a product is at most one row per
task, however many of the clicks it has; exact visitor counts shuffle distinct (product, bucket,
visitor) rows spread over all three columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinview.functions import action_count, views_per_purchase
from twinview.schema import ADD_TO_CART, PAGE_VIEW, PURCHASE, VIEW_KEYS

# Precision of the visitor sketches: 2^12 registers (fixed value).
SKETCH_BITS = 12

# Relative error at which approx_count_distinct uses 2^12 registers (fixed value).
ONESHOT_ERROR = 0.0173


def _activity_counts() -> list[Column]:
    return [
        action_count(PURCHASE).alias("purchase_count"),
        action_count(ADD_TO_CART).alias("add_to_cart_count"),
        action_count(PAGE_VIEW).alias("page_view_count"),
    ]


def recent(activity: DataFrame, hours: int = 6, as_of: int | None = None, until: int | None = None) -> DataFrame:
    """Buckets that start at most ``hours`` before ``as_of`` (epoch seconds, default now).

    Buckets in the future pass, unless they start at ``until`` (epoch seconds) or later. The bound is a constant compared with the bare partition column,
    so folders outside of it are not even listed for the scan.
    """
    now = F.unix_timestamp() if as_of is None else F.lit(as_of).cast("long")
    since = activity.where(F.col("timestamp_hour") >= (now - hours * 3600) * 1000)
    return since if until is None else since.where(F.col("timestamp_hour") < until * 1000)


def activity_by_product(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Purchases, cart additions and page views per key.

    Other actions count nowhere, but their key is still in the result.
    """
    return activity.groupBy(*keys).agg(*_activity_counts())


def visitors_by_product(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Exact number of distinct visitors per key."""
    return activity.groupBy(*keys).agg(F.count_distinct("visitor").alias("unique_visitors"))


def product_summary(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Action counts and exact visitors per key, both from one pass over the clicks."""
    return activity.groupBy(*keys).agg(
        *_activity_counts(), F.count_distinct("visitor").alias("unique_visitors")
    )


def visitor_sketches(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """A mergeable sketch of the visitors per key."""
    return activity.groupBy(*keys).agg(F.hll_sketch_agg("visitor", SKETCH_BITS).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches united to fewer keys."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate_visitors(sketches: DataFrame) -> DataFrame:
    """Sketches replaced by the number of visitors they stand for."""
    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, F.hll_sketch_estimate("sketch").alias("unique_visitors"))


def approx_visitors_by_product(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Approximate number of distinct visitors per key, from sketches."""
    return estimate_visitors(visitor_sketches(activity, keys))


def approx_visitors_oneshot(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Approximate number of distinct visitors per key where no sketch is to be kept."""
    estimate = F.approx_count_distinct("visitor", ONESHOT_ERROR)
    return activity.groupBy(*keys).agg(estimate.alias("unique_visitors"))


def visitors_summary(activity: DataFrame, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """Exact, sketched and one-shot number of visitors per key, all from one pass over the clicks.

    All three ignore repeats, so the clicks are reduced to distinct visitors first, map-side; a
    sketch is made of those, one for each task and key, not one for each visitor.
    """
    visitors = activity.select(*keys, "visitor").distinct()
    return visitors.groupBy(*keys).agg(
        F.count("visitor").alias("unique_visitors"),
        F.hll_sketch_estimate(F.hll_sketch_agg("visitor", SKETCH_BITS)).alias("sketched"),
        F.approx_count_distinct("visitor", ONESHOT_ERROR).alias("oneshot"),
    )


def under_exposed(view: DataFrame) -> DataFrame:
    """An activity view with whole page views per purchase, 0 where nothing was bought."""
    return view.withColumn("under_exposed", views_per_purchase())
