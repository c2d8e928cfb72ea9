"""The batch job: recent activity of the master dataset to the two batch views."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from twinview.operators import product_summary, recent
from twinview.schema import ACTIVITY_BY_PRODUCT, VISITORS_BY_PRODUCT
from twinview.sinks import save_batch_view
from twinview.sources import read_master


def run_batch_views(
    spark: SparkSession,
    master_path: str,
    out_path: str,
    hours: int = 6,
    as_of: int | None = None,
    mode: str = "buckets",
) -> tuple[str, str]:
    """Recompute both views; returns the paths of the activity and the visitor view.

    The clicks are scanned and shuffled once for both views. What is kept in between is the
    aggregate, one row per product and bucket, not the clicks.
    """
    as_of = int(time.time()) if as_of is None else as_of
    since_ms = (as_of - hours * 3600) * 1000
    clicks = recent(read_master(spark, master_path, since_ms=since_ms), hours, as_of)
    summary = product_summary(clicks).persist(StorageLevel.MEMORY_AND_DISK)
    activity_path = f"{out_path}/batch_activity_by_product"
    visitors_path = f"{out_path}/batch_visitors_by_product"
    try:
        save_batch_view(summary.select(*ACTIVITY_BY_PRODUCT.names), activity_path, mode)
        save_batch_view(summary.select(*VISITORS_BY_PRODUCT.names), visitors_path, mode)
    finally:
        summary.unpersist()
    return activity_path, visitors_path
