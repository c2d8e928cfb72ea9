"""Measures of the activity view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def action_count(name: str) -> Column:
    """Number of rows with this action; 0, not NULL, for a group that has none."""
    return F.sum(F.when(F.col("action") == name, F.lit(1)).otherwise(F.lit(0)))


def views_per_purchase(views: str = "page_view_count", purchases: str = "purchase_count") -> Column:
    """Whole page views per purchase, 0 where nothing was bought."""
    return F.expr(f"CASE WHEN `{purchases}` = 0 THEN 0L ELSE `{views}` div `{purchases}` END")
