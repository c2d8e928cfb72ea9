"""Small reports over the views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinview.functions import bucket_label


def register(df: DataFrame, name: str, cache: bool = False) -> DataFrame:
    """Make a DataFrame a SQL table of this session, replacing one of the same name."""
    df.createOrReplaceTempView(name)
    if cache:
        df.sparkSession.catalog.cacheTable(name)
    return df


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; any ``n`` unless an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def views_by_name_length(view: DataFrame) -> DataFrame:
    """Page views per length of the product name."""
    return view.groupBy(F.length("product").alias("len")).agg(
        F.sum("page_view_count").alias("page_views")
    )


def labelled_buckets(
    view: DataFrame, pattern: str = "MM-dd HH:mm:00", zone: str | None = None
) -> DataFrame:
    """An activity view with its buckets as text."""
    label = bucket_label("timestamp_hour", pattern, zone).alias("timestamphour")
    return view.select(label, "purchase_count", "add_to_cart_count", "page_view_count")


def compare_visitors(
    summary: DataFrame,
    products: Sequence[str] | None = None,
    pattern: str = "HH:mm:00",
    zone: str | None = None,
) -> DataFrame:
    """Sketched and exact visitor counts of a ``visitors_summary`` below each other, for some
    products or for all. Both rows of a key are made of its one row: the clicks are read once."""
    if products is not None:
        summary = summary.where(F.col("product").isin(*products))
    none = F.lit(0).cast("long")
    rows = F.array(
        F.struct(F.col("sketched").alias("unique_visitors_hll"), none.alias("unique_visitors_precise")),
        F.struct(none.alias("unique_visitors_hll"), F.col("unique_visitors").alias("unique_visitors_precise")),
    )
    label = bucket_label("timestamp_hour", pattern, zone).alias("timestamphour")
    return summary.select(label, "product", F.inline(rows))
