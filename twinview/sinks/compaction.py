"""Merging the many small folders that micro-batches leave in a master dataset.

A job beside the writers, to be run now and then (say once a day). It touches only closed buckets,
those before a time from which on clicks still come; a late click there is a folder of its own,
merged the next time. How readers and replayed writes stay right is said in ``sources.merges``.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinview import files
from twinview.functions import DAY_MS
from twinview.schema import MASTER_BATCH, MASTER_PARTITIONS
from twinview.sources import merges
from twinview.sources.master import STORED, bucket_folders

# Names of writes: a stream's are its writer's, a dash and the micro-batch; those without one are a UUID.
_STREAMED = r"^([0-9a-f]{16})-([0-9]+)$"
_ONCE = rf"{_STREAMED}|^[0-9a-f]{{32}}$|^{merges.MERGED}[0-9]+$"


def _begin(spark: SparkSession, path: str, now_ms: int, stale_ms: int) -> int:
    begun, done, log = merges.numbers(spark, path, "begun"), set(merges.numbers(spark, path, "done")), merges.merge_log(path)
    under_way = [n for n in begun if n not in done and files.age_ms(spark, f"{log}/begun/merge={n}", now_ms) < stale_ms]
    number = (begun[-1] if begun else 0) + 1
    if under_way or not files.create(spark, f"{log}/begun/merge={number}"):
        raise RuntimeError(f"a merge of {path} is under way ({under_way or number})")
    return number


def _mergeable(rows: DataFrame) -> DataFrame:
    """Folders to merge: all of a bucket, but for one that is merged alone, and each stream's newest.

    Only its newest micro-batch can be written again by a stream; as it is left alone, the others
    need not be remembered for ever. A single write is merged too: then closed buckets hold nothing
    but merged folders, whose ends are noted, and late clicks.
    """
    folders = rows.select(*merges.FOLDER).distinct()
    writer, number = (F.regexp_extract(MASTER_BATCH, _STREAMED, i) for i in (1, 2))
    folders = folders.withColumn("writer", writer).withColumn("number", number.try_cast("long"))
    newest = folders.where("writer <> ''").groupBy("writer").agg(F.max("number").alias("newest"))
    old = folders.join(newest, "writer", "left").where("newest is null or number < newest")
    several = F.count(F.lit(1)).over(Window.partitionBy(*MASTER_PARTITIONS)) > 1
    return old.withColumn("several", several).where(F.col("several") | ~F.col(MASTER_BATCH).startswith(merges.MERGED)).select(*merges.FOLDER)


def compact_master(
    spark: SparkSession, path: str, before_ms: int, since_ms: int | None = None,
    now_ms: int | None = None, stale_ms: int = DAY_MS,
) -> int | None:
    """Merge the folders of each bucket before ``before_ms`` (and from ``since_ms`` on) into one, and
    return the merge's number; None if there is nothing to merge.

    Files are as large as AQE's advisory partition size. Old folders stay until ``vacuum_master``,
    for readers under way. RuntimeError if another merge is under way; one that has begun
    ``stale_ms`` ago and isn't done is taken for lost, and never counts.
    """
    now_ms = time.time_ns() // 1_000_000 if now_ms is None else now_ms
    buckets = bucket_folders(spark, path, since_ms, before_ms)
    if not buckets:
        return None
    number, log = _begin(spark, path, now_ms, stale_ms), merges.merge_log(path)
    # the files are listed here, once: the list of folders and the rows merged are of the same state
    stored = merges.live(spark.read.schema(STORED).option("basePath", path).parquet(*buckets), path)
    mergeable = _mergeable(stored).withColumn("once", F.col(MASTER_BATCH).rlike(_ONCE))
    whole = f"{log}/listed/merge={number}"
    mergeable.hint("rebalance").write.mode("overwrite").parquet(whole)
    listed = spark.read.schema(mergeable.schema).parquet(whole)
    if listed.isEmpty():
        files.delete(spark, [whole, f"{log}/begun/merge={number}"])
        return None
    for kind, which in (("replaced", F.col("once")), ("kept", ~F.col("once"))):
        listed.where(which).drop("once").write.mode("overwrite").parquet(f"{log}/{kind}/merge={number}")
    name = f"{merges.MERGED}{number}"
    rows = merges.in_folders(stored, listed.drop("once"), "left_semi")
    (rows.withColumn(MASTER_BATCH, F.lit(name)).hint("rebalance", *MASTER_PARTITIONS)
        .write.mode("append").partitionBy(*merges.FOLDER).parquet(path))
    merges.write_ends(rows, path, name)
    files.delete(spark, [whole])
    if not files.create(spark, f"{log}/done/merge={number}"):
        raise RuntimeError(f"merge {number} of {path} has been done by another")
    return number


def _level(spark: SparkSession, column: str, value) -> str:
    """The name that Spark gives a partition's folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
        column, None if value is None else str(value))


def vacuum_master(spark: SparkSession, path: str, keep_ms: int = DAY_MS, now_ms: int | None = None) -> int:
    """Delete folders that merges replaced at least ``keep_ms`` ago, and what lost merges left; returns
    the number of folders. Readers that began before that must have ended.

    What may be written again (jobs' writes with a name) stays on the list.
    """
    now_ms = time.time_ns() // 1_000_000 if now_ms is None else now_ms
    log, done, deleted = merges.merge_log(path), merges.numbers(spark, path, "done"), 0
    for number in merges.numbers(spark, path, "replaced"):
        begun = f"{log}/begun/merge={number}"
        if number not in done:
            if files.exists(spark, begun) and files.age_ms(spark, begun, now_ms) >= keep_ms:  # lost, and never seen
                levels = "/".join(f"{c}=*" for c in MASTER_PARTITIONS)
                left = files.glob(spark, f"{path}/{levels}/{MASTER_BATCH}={merges.MERGED}{number}")
                files.delete(spark, [*left, f"{merges.ends_table(path)}/{MASTER_BATCH}={merges.MERGED}{number}",
                                     *(f"{log}/{kind}/merge={number}" for kind in ("replaced", "kept", "listed"))])
                deleted += len(left)
            continue
        if files.age_ms(spark, f"{log}/done/merge={number}", now_ms) < keep_ms:
            continue
        lists = [f"{log}/{kind}/merge={number}" for kind in ("replaced", "kept")]
        for row in spark.read.schema(merges.REPLACED).parquet(*lists).toLocalIterator():
            files.delete(spark, [f"{path}/" + "/".join(_level(spark, c, row[c]) for c in merges.FOLDER),
                                 f"{merges.ends_table(path)}/{MASTER_BATCH}={row[MASTER_BATCH]}"])
            deleted += 1
        files.delete(spark, [f"{log}/replaced/merge={number}"])
    return deleted
