"""Dimension files: one entry per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product lines: the raw line, as click lines carry it, and its brand and name."""
    parts = F.from_csv("value", "brand STRING, name STRING", {"quote": '"', "escape": '"'})
    return (
        spark.read.text(path)
        .select(F.col("value").alias("product"), parts.alias("parts"))
        .select("product", "parts.brand", "parts.name")
    )


def read_referrers(spark: SparkSession, path: str) -> DataFrame:
    """Referrer names."""
    return spark.read.text(path).select(F.col("value").alias("referrer"))
