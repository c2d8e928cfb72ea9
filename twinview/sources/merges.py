"""The log of a master dataset's merges, and which of its folders count.

Beside the dataset, so that no reader of its folders meets it:

    <path>_merges/begun/merge=<n>     merge n has begun (a file, created exclusively)
    <path>_merges/replaced/merge=<n>/ the folders it replaces
    <path>_merges/kept/merge=<n>/     those of them that may be written again at any time
    <path>_merges/done/merge=<n>      merge n counts (a file): the switch
    <path>_ends/batch=<name>/         where the write of that name ends, by Kafka partition

A folder ``batch=merged-<n>`` counts if merge n is done, and a folder that a done merge replaces
does not. So a reader sees all of a merge or nothing, and a write that is done again under its
name, after its folder was merged, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview import files
from twinview.schema import MASTER, MASTER_BATCH, MASTER_PARTITIONS

MERGED = "merged-"
FOLDER = (*MASTER_PARTITIONS, MASTER_BATCH)
REPLACED = T.StructType([*(MASTER[name] for name in MASTER_PARTITIONS), T.StructField(MASTER_BATCH, T.StringType())])
ENDS = T.StructType([MASTER["topic"], MASTER["kafkaPartition"], T.StructField("untilOffset", T.LongType())])


def merge_log(path: str) -> str:
    return f"{path.rstrip('/')}_merges"


def ends_table(path: str) -> str:
    return f"{path.rstrip('/')}_ends"


def numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the merges that are ``begun``, ``done``, or have a list (``replaced``, ``kept``)."""
    return sorted(int(p.rsplit("=", 1)[1]) for p in files.glob(spark, f"{merge_log(path)}/{kind}/merge=*"))


def _same_folder(left: str, right: str) -> Column:
    found = F.lit(True)
    for name in FOLDER:
        found &= F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return found


def in_folders(rows: DataFrame, folders: DataFrame, how: str) -> DataFrame:
    """Rows in one of the folders (``how="left_semi"``), or in none of them ("left_anti")."""
    return rows.alias("rows").join(folders.alias("folders"), _same_folder("rows", "folders"), how)


def live(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a master dataset, with its folders' columns, that count.

    ``rows`` must have been listed before: then a merge that begins now is in no file of theirs.
    """
    spark = rows.sparkSession
    if not numbers(spark, path, "begun"):
        return rows
    done = numbers(spark, path, "done")
    merged = [f"{MERGED}{n}" for n in done]
    rows = rows.where(~F.col(MASTER_BATCH).startswith(MERGED) | F.col(MASTER_BATCH).isin(*merged))
    lists = [f"{merge_log(path)}/{kind}/merge={n}" for kind in ("replaced", "kept")
             for n in sorted(set(numbers(spark, path, kind)) & set(done))]
    if not lists:
        return rows
    replaced = spark.read.schema(REPLACED).parquet(*lists).distinct()
    return in_folders(rows, replaced, "left_anti")


def write_ends(rows: DataFrame, path: str, batch: str) -> None:
    """Note where a write ends, once all its rows (with topic, kafkaPartition, untilOffset) are stored."""
    ends = rows.where("untilOffset is not null").groupBy("topic", "kafkaPartition").agg(
        F.max(F.col("untilOffset").cast("long")).alias("untilOffset"))
    # few rows, one for each Kafka partition: one file
    ends.select("topic", F.col("kafkaPartition").cast("int").alias("kafkaPartition"), "untilOffset").coalesce(1).write.mode("overwrite").parquet(
        f"{ends_table(path)}/{MASTER_BATCH}={batch}")


def noted_writes(spark: SparkSession, path: str) -> list[str]:
    """Names of the writes whose ends are noted."""
    found = files.glob(spark, f"{ends_table(path)}/{MASTER_BATCH}=*/_SUCCESS")
    return sorted(p.split(f"{MASTER_BATCH}=")[-1].removesuffix("/_SUCCESS") for p in found)
