"""The master dataset, the stream positions it implies, and the views saved from it."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview import files
from twinview.schema import MASTER, MASTER_BATCH, MASTER_PARTITIONS
from twinview.sources import merges

# The Kafka source's code for a partition's earliest offset (fixed value).
EARLIEST = -2


STORED = T.StructType([*MASTER.fields, T.StructField(MASTER_BATCH, T.StringType())])


def bucket_folders(spark: SparkSession, path: str, since_ms: int | None = None, before_ms: int | None = None) -> list[str] | None:
    """Folders of the buckets from ``since_ms`` on and before ``before_ms``; None if there is nothing
    at the path.

    A folder without a bucket (a null one) is neither recent nor past.
    """
    if not files.exists(spark, path):
        return None

    def wanted(folder: str) -> bool:
        value = folder.rsplit("=", 1)[1]
        if not value.removeprefix("-").isdigit():
            return False
        return (since_ms is None or int(value) >= since_ms) and (before_ms is None or int(value) < before_ms)

    levels = "/".join(f"{name}=*" for name in MASTER_PARTITIONS)
    return [folder for folder in files.glob(spark, f"{path}/{levels}") if wanted(folder)]


def read_master(
    spark: SparkSession, path: str, missing_ok: bool = False, since_ms: int | None = None
) -> DataFrame:
    """The master dataset, by whomever it was written. With ``missing_ok`` an absent folder reads
    as no rows.

    With ``since_ms`` only buckets from then on are read, and the files of older ones are not even
    listed: listing a long history takes longer than scanning its last hours. Of folders that
    ``compact_master`` merged, the rows are read once, from before or after.
    """
    rows = _stored(spark, path, missing_ok, since_ms)
    return rows if rows.columns == MASTER.names else merges.live(rows, path).select(*MASTER.names)


def _stored(spark: SparkSession, path: str, missing_ok: bool, since_ms: int | None) -> DataFrame:
    """Rows of the folders as they lie there; without the write's name if there are none."""
    reader = spark.read.schema(STORED)
    try:
        folders = None if since_ms is None else bucket_folders(spark, path, since_ms)
        if folders == []:
            return spark.createDataFrame([], MASTER)
        if folders:
            return reader.option("basePath", path).parquet(*folders)
        return reader.parquet(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MASTER)
        raise


def read_view(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved batch view, its columns in the order of ``schema``."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def query_path(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Rows of a Parquet folder, straight from its path in SQL."""
    query = f"SELECT * FROM parquet.`{path.replace('`', '``')}`"
    return spark.sql(f"{query} WHERE {where}" if where else query)


def latest_offsets(master: DataFrame) -> DataFrame:
    """First offset not yet stored, per topic and Kafka partition.

    ``untilOffset`` is stored as text and is exclusive: compare as numbers, resume at it. Rows that
    have none, as they come from files, say nothing about a topic.
    """
    return master.where(F.col("untilOffset").isNotNull()).groupBy("topic", "kafkaPartition").agg(
        F.max(F.col("untilOffset").cast("long")).alias("untilOffset")
    )


def latest_offsets_of(spark: SparkSession, path: str) -> DataFrame:
    """``latest_offsets`` of the master dataset at ``path``, without reading what is noted already.

    Streams and merges note where each of their writes ends, once it is stored; only the folders of
    other writes are scanned, and those of a stream whose note is missing as it stopped in between.
    """
    noted = merges.noted_writes(spark, path)
    names = ["topic", "kafkaPartition", "untilOffset"]
    rows = _stored(spark, path, True, None)
    if MASTER_BATCH in rows.columns:
        rows = merges.live(rows.where(~F.col(MASTER_BATCH).isin(*noted)), path)
    found = latest_offsets(rows).select(*names)
    if noted:
        folders = [f"{merges.ends_table(path)}/{MASTER_BATCH}={name}" for name in noted]
        found = found.unionAll(spark.read.schema(merges.ENDS).parquet(*folders).select(*names))
    return found.groupBy("topic", "kafkaPartition").agg(F.max("untilOffset").alias("untilOffset"))


def starting_offsets_json(
    master: DataFrame, partition_counts: Mapping[str, int] | None = None
) -> str | None:
    """``latest_offsets`` as the Kafka source's startingOffsets JSON; None if nothing is stored.

    The source wants every partition of a topic: with ``partition_counts`` (topic to number of
    partitions) those not stored yet start at their earliest offset. What reaches the driver is
    one text with one number per Kafka partition.
    """
    per_topic = latest_offsets(master).groupBy("topic").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("kafkaPartition").cast("string"), "untilOffset"))
        ).alias("offsets")
    )
    row = per_topic.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "offsets")))).alias("json")
    ).first()
    stored = json.loads(row.json)
    if not stored:
        return None
    for topic, count in (partition_counts or {}).items():
        unknown = {str(p): EARLIEST for p in range(count)}
        stored[topic] = unknown | stored.get(topic, {})
    return json.dumps(stored)
