"""Where a line came from: the ``inputProps`` map, and its columns in the master dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinview.schema import MASTER_FIELDS, SOURCE_PROPS

SALTS = 64


def _props(*values: Column) -> Column:
    pairs = zip(SOURCE_PROPS, values, strict=True)
    return F.create_map(*(c for name, v in pairs for c in (F.lit(name), v.cast("string"))))


def with_record_props(lines: DataFrame) -> DataFrame:
    """Source properties with each record's own offset range, [offset, offset + 1).

    Needs ``topic``, ``partition`` and ``offset``; no shuffle, so it also works on a stream.
    """
    props = _props(F.col("topic"), F.col("partition"), F.col("offset"), F.col("offset") + 1)
    return lines.withColumn("inputProps", props)


def with_file_props(lines: DataFrame, topic: str) -> DataFrame:
    """Source properties of lines read from files, which have no offsets to resume at."""
    none = F.lit(None).cast("string")
    return lines.withColumn("inputProps", _props(F.lit(topic), F.lit(0), none, none))


def with_source_props(lines: DataFrame, ranges: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """Source properties with the offset range the batch holds of each Kafka partition.

    Needs ``topic``, ``partition`` and ``offset``, on a batch (inside ``foreachBatch`` for a
    stream). ``ranges`` (topic, partition, fromOffset, untilOffset) may be given where the offsets
    of the batch are known; else they are taken from the lines, in a pass of its own. There is one
    for each Kafka partition, which the optimizer sends to the lines if that is little; if not,
    the salt keeps a Kafka partition from being one task.
    """
    if ranges is None:
        ranges = lines.groupBy("topic", "partition").agg(
            F.min("offset").alias("fromOffset"), (F.max("offset") + 1).alias("untilOffset")
        )
    keys = ["topic", "partition"]
    salt = F.pmod(F.xxhash64("offset"), F.lit(salts)).cast("int")
    copies = ranges.select(*keys, "fromOffset", "untilOffset", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    joined = lines.withColumn("salt", salt).join(copies, [*keys, "salt"]).drop("salt")
    props = _props(F.col("topic"), F.col("partition"), F.col("fromOffset"), F.col("untilOffset"))
    return joined.withColumn("inputProps", props).drop("fromOffset", "untilOffset")


def flatten_props(activity: DataFrame) -> DataFrame:
    """Activities with their source properties as columns, in master dataset order."""
    return activity.select(
        "timestamp_hour", *MASTER_FIELDS,
        *(F.element_at("inputProps", F.lit(name)).alias(name) for name in SOURCE_PROPS),
    )
