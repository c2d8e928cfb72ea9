"""A keyed view kept as a changelog in Parquet.

    <path>/changes/batch_id=<n>/              what micro-batch n changed, one row per changed key
    <path>/base/[day=<d>/]upto=<n>/           what all batches up to n come to, by day of the bucket
    <path>/marks/upto=<n>/                    compaction n is whole

A replayed micro-batch replaces its own folder, so a retry changes nothing. Folders count only once
their ``_SUCCESS`` marker is there, so a reader never sees half a batch or half a base. A reader
goes through each day's newest base up to the newest mark and the batches after that mark.

Micro-batches only write; ``compact_view`` is a job of its own, from time to time, beside them. It
rewrites the days that have changed and leaves all others where they are: there is one folder a day,
however fine the buckets, and the bucket is a column with statistics in its files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview import files
from twinview.functions import DAY_MS
from twinview.operators.snapshots import last_per_key
from twinview.schema import VIEW_KEYS

BATCH_ID = "batch_id"
BUCKET = "timestamp_hour"
DAY = "day"
UPTO = "upto"


def _numbers(spark: SparkSession, parent: str, name: str) -> list[int]:
    """Numbers of the completed folders <parent>/<name>=<number>."""
    found = files.glob(spark, f"{parent}/{name}=*/_SUCCESS")
    return sorted(int(p.removesuffix("/_SUCCESS").rsplit("=", 1)[1]) for p in found)


def _bases(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, dict[int, str]]:
    """Folders of each day's bases by the batch they reach up to."""
    levels = f"{DAY}=*/{UPTO}=*" if BUCKET in schema.names else f"{UPTO}=*"
    out: dict[str, dict[int, str]] = {}
    for folder in files.glob(spark, f"{path}/base/{levels}"):
        day, upto = folder.split("/")[-2:]
        out.setdefault(day, {})[int(upto.split("=")[1])] = folder
    return out


def newest_mark(spark: SparkSession, path: str) -> int | None:
    """The batch that the newest compaction reaches up to."""
    return next(reversed(_numbers(spark, f"{path}/marks", UPTO)), None)


def _mark(spark: SparkSession, path: str, upto: int) -> None:
    files.create(spark, f"{path}/marks/{UPTO}={upto}/_SUCCESS")


def write_changes(changes: DataFrame, path: str, batch_id: int) -> None:
    """Store what one micro-batch changed, replacing an earlier try of the same batch.

    The number of files follows the size of the data, not the number of shuffle partitions.
    """
    changes.hint("rebalance").write.mode("overwrite").parquet(f"{path}/changes/{BATCH_ID}={batch_id}")


def _read(
    spark: SparkSession, path: str, schema: T.StructType, newest: int, days: set[str] | None = None
) -> DataFrame:
    """Rows of all batches up to ``newest``, with the ``batch_id`` up to which they reach."""
    logged = T.StructType([*schema.fields, T.StructField(BATCH_ID, T.LongType())])
    marks = [n for n in _numbers(spark, f"{path}/marks", UPTO) if n <= newest]
    mark = marks[-1] if marks else -1
    batches = [n for n in _numbers(spark, f"{path}/changes", BATCH_ID) if mark < n <= newest]
    rows = spark.createDataFrame([], logged)
    if batches:
        folders = [f"{path}/changes/{BATCH_ID}={n}" for n in batches]
        rows = spark.read.schema(logged).option("basePath", f"{path}/changes").parquet(*folders)
    bases = []
    for day, folders in _bases(spark, path, schema).items():
        known = [n for n in folders if n <= mark]
        if known and (days is None or day in days):
            bases.append(folders[max(known)])
    if bases:
        stored = T.StructType([*schema.fields, T.StructField(UPTO, T.LongType())])
        base = spark.read.schema(stored).option("basePath", f"{path}/base").parquet(*bases)
        rows = base.select(*schema.names, F.col(UPTO).alias(BATCH_ID)).unionByName(rows)
    return rows


def changes_between(spark: SparkSession, path: str, schema: T.StructType, after: int) -> tuple[DataFrame, int]:
    """Rows of the batches after this one, with their ``batch_id``, and the newest (``after`` if none is)."""
    logged = T.StructType([*schema.fields, T.StructField(BATCH_ID, T.LongType())])
    batches = [n for n in _numbers(spark, f"{path}/changes", BATCH_ID) if n > after]
    if not batches:
        return spark.createDataFrame([], logged), after
    folders = [f"{path}/changes/{BATCH_ID}={n}" for n in batches]
    return spark.read.schema(logged).option("basePath", f"{path}/changes").parquet(*folders), batches[-1]


def read_changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest base of each day and the batches after it, with their ``batch_id``."""
    return _read(spark, path, schema, 1 << 62)


def latest_view(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = VIEW_KEYS
) -> DataFrame:
    """The last row per key, without the log's own ``batch_id``."""
    return last_per_key(read_changes(spark, path, schema), keys, BATCH_ID).drop(BATCH_ID)


def _day() -> Column:
    return F.floor(F.col(BUCKET) / DAY_MS)


def compact_view(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = VIEW_KEYS,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
    carry: bool = True,
    upto: int | None = None,
) -> int | None:
    """Write new bases and return the batch they reach up to, None if there was nothing to do.

    Batches after ``upto`` are left as they are.
    ``resolve`` makes of a day's rows those to keep, else the last row per key stays. With
    ``carry`` days without a change stay as they are. What the new bases cover stays until
    ``drop_compacted``, for readers already under way.
    """
    batches = [n for n in _numbers(spark, f"{path}/changes", BATCH_ID) if upto is None or n <= upto]
    marks = _numbers(spark, f"{path}/marks", UPTO)
    if not batches or (marks and marks[-1] >= batches[-1]):
        return None
    newest, by_day, touched = batches[-1], BUCKET in schema.names, None
    if by_day and carry:
        fresh = [f"{path}/changes/{BATCH_ID}={n}" for n in batches if not marks or n > marks[-1]]
        found = spark.read.schema(schema).parquet(*fresh).select(_day().alias(DAY)).distinct()
        touched = {f"{DAY}={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}" for r in found.collect()}  # folders to be written
    rows = _read(spark, path, schema, newest, touched)
    rows = resolve(rows) if resolve else last_per_key(rows, keys, BATCH_ID)
    rows = rows.select(*schema.names).withColumn(UPTO, F.lit(newest).cast("long"))
    levels = [DAY, UPTO] if by_day else [UPTO]
    rows = rows.withColumn(DAY, _day()) if by_day else rows
    writer = rows.hint("rebalance", *levels).write.partitionBy(*levels)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/base")
    if not carry:  # a day of which nothing is kept must not be read from its older base
        _retire(spark, path, schema, newest)
    _mark(spark, path, newest)
    return newest


def _retire(spark: SparkSession, path: str, schema: T.StructType, newest: int) -> None:
    """Give days without a row in the new base an empty one."""
    for folders in _bases(spark, path, schema).values():
        if newest not in folders:
            files.make(spark, next(iter(folders.values())).rsplit("/", 1)[0] + f"/{UPTO}={newest}")


def drop_compacted(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Delete what the mark before the newest one covers, but for the bases it reads."""
    marks = _numbers(spark, f"{path}/marks", UPTO)
    if len(marks) < 2:
        return
    mark = marks[-2]
    batches = _numbers(spark, f"{path}/changes", BATCH_ID)
    old = [f"{path}/changes/{BATCH_ID}={n}" for n in batches if n <= mark]
    for folders in _bases(spark, path, schema).values():
        known = [n for n in folders if n <= mark]
        old += [folders[n] for n in known if n < max(known)]
    old += [f"{path}/marks/{UPTO}={n}" for n in marks[:-2]]
    files.delete(spark, old)


def drop_batches(spark: SparkSession, path: str, before: int) -> None:
    """Delete the changes of batches before this one, where only the newest batch is of use."""
    batches = _numbers(spark, f"{path}/changes", BATCH_ID)
    files.delete(spark, [f"{path}/changes/{BATCH_ID}={n}" for n in batches if n < before])
