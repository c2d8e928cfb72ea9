"""Clicks out of a generic ``events`` table (event_id, ts, user_id, event_type, props)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinview.functions import HOUR_MS, bucket
from twinview.schema import ADD_TO_CART, PAGE_VIEW, PURCHASE

# Referrers of the click simulator (fixed values).
REFERRERS = ("Google", "Bing", "Yahoo", "Twitter", "Facebook", "Other", "Direct", "Internal")

# Number of pages of the simulated shop (fixed value).
PAGES = 15

# props is one flat {"k": n}: a pattern finds n in a tenth of the time of a JSON parser.
PRODUCT_NUMBER = r'"k"\s*:\s*([0-9]+)'


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _page(number: Column) -> Column:
    return F.concat(F.lit("Page - "), number % PAGES)


def events_to_activity(events: DataFrame, bucket_ms: int = HOUR_MS) -> DataFrame:
    """Activity columns plus ``event_id`` and the exact ``ts_ms``. Row by row, no shuffle."""
    event_id, event_type = F.col("event_id"), F.col("event_type")
    # ts has no zone: count from the epoch on the same clock, whatever the session's zone is.
    ts_ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    referrer = F.element_at(
        F.array(*map(F.lit, REFERRERS)), (event_id % len(REFERRERS) + 1).cast("int")
    )
    action = (
        F.when(event_type == "purchase", PURCHASE)
        .when(event_type == "click", ADD_TO_CART)
        .when(event_type == "view", PAGE_VIEW)
        .otherwise(event_type)
    )
    return events.select(
        "event_id",
        ts_ms.alias("ts_ms"),
        bucket(ts_ms, bucket_ms).alias("timestamp_hour"),
        referrer.alias("referrer"),
        action.alias("action"),
        F.when(referrer == "Internal", _page(event_id + 1)).otherwise("").alias("prevPage"),
        F.concat(F.lit("Visitor - "), "user_id").alias("visitor"),
        _page(event_id).alias("page"),
        F.concat(F.lit("Product - "), F.regexp_extract("props", PRODUCT_NUMBER, 1)).alias("product"),
    )
