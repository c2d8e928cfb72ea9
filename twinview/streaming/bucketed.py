"""A changelog's base laid out by key, with Spark's own bucketing.

    <path>/bucketed/upto=<n>/              what all batches up to n come to, in buckets by a hash of the key
    <path>/bucketed_marks/upto=<n>/buckets=<b>  it is whole, and has b buckets

For views with very many keys and few changes. ``latest_view`` shuffles base and log together; here only
the log after the base is shuffled, and the base meets it bucket by bucket, when it is read and when the
next base is made of it. The log is the one that ``upsert_view`` and ``write_changes`` write.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview import files
from twinview.operators.snapshots import last_per_key
from twinview.schema import VIEW_KEYS
from twinview.streaming.changelog import BATCH_ID, UPTO, changes_between, drop_batches

#: The bucketed column: never null, and one, so that a join on it finds the base where it lies.
HASH = "key_hash"
BUCKETS = 200


def _marks(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Batch and number of buckets of each whole base, by batch."""
    found = [p.split("/")[-2:] for p in files.glob(spark, f"{path}/bucketed_marks/{UPTO}=*/buckets=*")]
    return sorted((int(upto.split("=")[1]), int(buckets.split("=")[1])) for upto, buckets in found)


def _folder(path: str, upto: int) -> str:
    return f"{path}/bucketed/{UPTO}={upto}"


def _name(path: str, upto: int) -> str:
    return f"base_{hashlib.sha256(path.encode()).hexdigest()[:16]}_{upto}"


def _base(spark: SparkSession, path: str, schema: T.StructType, upto: int, buckets: int) -> DataFrame:
    """The base as a table of this session's catalog, which is how Spark learns of its buckets."""
    stored = T.StructType([*schema.fields, T.StructField(HASH, T.LongType())])
    name = _name(path, upto)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {buckets} BUCKETS "
                  f"LOCATION '{_folder(path, upto)}'")
    return spark.table(name)


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, nulls too. As a number of equal ones, so that the join's only key is the hash."""
    equal = [F.col(f"base.{k}").eqNullSafe(F.col(f"fresh.{k}")).cast("int") for k in keys]
    return (F.col(f"base.{HASH}") == F.col(f"fresh.{HASH}")) & (sum(equal[1:], equal[0]) == len(keys))


def _parts(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> tuple[list[DataFrame], int, tuple[int, int] | None]:
    """What of the base no later batch has changed, and the last row of each key changed since; the
    newest batch, and the base's mark."""
    mark = next(reversed(_marks(spark, path)), None)
    changes, newest = changes_between(spark, path, schema, mark[0] if mark else -1)
    fresh = last_per_key(changes, keys, BATCH_ID).drop(BATCH_ID).withColumn(HASH, F.xxhash64(*keys))
    if mark is None:
        return [fresh], newest, None
    base = _base(spark, path, schema, *mark)
    kept = base.alias("base").join(fresh.alias("fresh"), _same(keys), "left_anti")
    return [kept.select(*schema.names, HASH), fresh.select(*schema.names, HASH)], newest, mark


def latest_bucketed_view(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = VIEW_KEYS) -> DataFrame:
    """The last row per key, as ``latest_view``; also without a base."""
    parts, _, _ = _parts(spark, path, schema, keys)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    return rows.select(*schema.names)


def compact_bucketed_view(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = VIEW_KEYS, buckets: int | None = None
) -> int | None:
    """Write the next base; returns the batch it reaches up to, None if there was nothing to do.

    ``buckets``: of the first base BUCKETS unless given, of a later one as many as before. Another number deals
    the base anew, once. The base before stays, for readers under way, the one before that goes.
    """
    parts, newest, mark = _parts(spark, path, schema, keys)
    if mark and newest <= mark[0] or newest < 0:
        return None
    buckets = buckets or (mark[1] if mark else BUCKETS)
    as_before = mark is not None and mark[1] == buckets
    # a bucket of the base stays with its task; the changed rows come as one more file a bucket
    rows = parts[-1].repartition(buckets, HASH)
    if mark is not None:
        rows = rows.unionAll(parts[0] if as_before else parts[0].repartition(buckets, HASH))
    folder = _folder(path, newest)
    files.delete(spark, [folder])  # left by a try that was lost
    spark.sql(f"DROP TABLE IF EXISTS {_name(path, newest)}")
    rows.write.format("parquet").bucketBy(buckets, HASH).sortBy(HASH).option("path", folder).saveAsTable(_name(path, newest))
    files.create(spark, f"{path}/bucketed_marks/{UPTO}={newest}/buckets={buckets}")
    for upto, _ in _marks(spark, path)[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {_name(path, upto)}")
        files.delete(spark, [f"{path}/bucketed_marks/{UPTO}={upto}", _folder(path, upto)])
    return newest


def drop_bucketed(spark: SparkSession, path: str) -> None:
    """Delete the batches that the base before the newest covers. Only for a view that is compacted in
    no other way: ``latest_view`` does not know of this base."""
    marks = _marks(spark, path)
    if len(marks) > 1:
        drop_batches(spark, path, before=marks[-2][0] + 1)
