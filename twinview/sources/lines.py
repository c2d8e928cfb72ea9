"""Click lines from text folders and Kafka topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_click_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file or folder, as column ``value``."""
    return spark.read.text(path)


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Kafka source options. A cold start reads from the latest offset unless told otherwise.

    ``options`` are any others of the source (kafka.group.id, failOnDataLoss, security settings),
    passed on as they are and before all else.

    ``min_partitions`` above the topic's own count splits a hot Kafka partition over several tasks.
    """
    found = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets or "latest",
    }
    if min_partitions is not None:
        found["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        found["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return found | dict(options or {})


def read_click_stream(
    spark: SparkSession,
    fmt: str = "text",
    path: str | None = None,
    max_files_per_trigger: int | None = None,
    **kafka,
) -> DataFrame:
    """Stream of click lines in column ``value``.

    ``fmt="text"`` follows a folder; ``fmt="kafka"`` a topic (see kafka_options for the arguments)
    and also returns ``topic``, ``partition`` and ``offset``.
    """
    if fmt == "text":
        reader = spark.readStream.format("text")
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path)
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**kafka_options(**kafka)).load()
        return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
    raise ValueError(f"fmt is 'text' or 'kafka', not {fmt!r}")
