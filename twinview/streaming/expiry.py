"""Running views whose keys expire: a key without new data for more than ``ttl_ms`` starts over.

A micro-batch only appends: its own aggregates per key, with the time it ran at (``changelog``).
No state is read for that, so its cost follows its own data. Which batches belong to a key's current
run is found on reading, with Spark's session windows over the times: a run ends where the key had
no data for longer than the limit. Compaction replaces each run by one row and drops those that
have ended. The clock must not run backwards; the limit is an argument of reading alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from twinview.operators.views import activity_by_product, visitor_sketches
from twinview.schema import ACTIVITY_BY_PRODUCT, VIEW_KEYS, VISITORS_BY_PRODUCT
from twinview.streaming.changelog import compact_view, drop_compacted, newest_mark, read_changes, write_changes
from twinview.streaming.queries import EVERY_SNAPSHOT, start_batches

# Time without new data after which a key expires (fixed value).
TTL_MS = 120 * 60 * 1000

SINCE, LAST_SEEN = "since_ms", "last_seen_ms"


def wall_clock_ms() -> int:
    return time.time_ns() // 1_000_000


_TIMES = [T.StructField(SINCE, T.LongType()), T.StructField(LAST_SEEN, T.LongType())]
_KEYS = [f for f in ACTIVITY_BY_PRODUCT if f.name in VIEW_KEYS]

# What a micro-batch appends of each key.
DELTAS = {
    "activity": T.StructType([*ACTIVITY_BY_PRODUCT, *_TIMES]),
    "visitors": T.StructType([*_KEYS, T.StructField("sketch", T.BinaryType()), *_TIMES]),
    "clicks": T.StructType([*VISITORS_BY_PRODUCT, *_TIMES]),
    "exact": T.StructType([*_KEYS, *_TIMES]),
}
# And for exact visitors of each key and visitor.
SEEN = T.StructType([*_KEYS, T.StructField("visitor", T.StringType()), *_TIMES[1:]])


def _check(kind: str) -> None:
    if kind not in DELTAS:
        raise ValueError(f"kind is one of {', '.join(DELTAS)}, not {kind!r}")


def _batch(kind: str, activity: DataFrame) -> DataFrame:
    if kind == "activity":
        return activity_by_product(activity)
    if kind == "visitors":
        return visitor_sketches(activity)
    if kind == "clicks":
        return activity.groupBy(*VIEW_KEYS).agg(F.count("*").alias("unique_visitors"))
    return activity.select(*VIEW_KEYS).distinct()


def _merged(kind: str) -> list[Column]:
    """A key's values out of those of several batches."""
    if kind == "visitors":
        return [F.hll_union_agg("sketch").alias("sketch")]
    names = {"activity": ACTIVITY_BY_PRODUCT.names[2:], "clicks": ["unique_visitors"], "exact": []}[kind]
    return [F.sum(name).alias(name) for name in names]


def append_batch(activity: DataFrame, path: str, batch_id: int, kind: str, now_ms: int) -> None:
    """Append what one micro-batch adds to the view at ``path``. Doing it again changes nothing."""
    times = [F.lit(now_ms).cast("long").alias(name) for name in (SINCE, LAST_SEEN)]
    if kind == "exact":
        seen = activity.select(*VIEW_KEYS, "visitor").where("visitor is not null").distinct()
        write_changes(seen.select("*", times[1]), f"{path}/seen", batch_id)
        path = f"{path}/view"
    delta = _batch(kind, activity).select("*", *times)
    write_changes(delta.select(*DELTAS[kind].names), path, batch_id)


def start_expiring_view(
    activity: DataFrame,
    path: str,
    kind: str = "activity",
    clock: Callable[[], int] = wall_clock_ms,
    checkpoint: str | None = None,
    trigger: Mapping = EVERY_SNAPSHOT,
) -> StreamingQuery:
    """Keep an expiring view at ``path``: action counts ("activity"), sketched visitors
    ("visitors"), exact visitors ("exact") or plain click counts ("clicks").

    ``live_view`` reads it; ``compact_expiring_view`` should be run now and then.
    """
    _check(kind)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append_batch(batch, path, batch_id, kind, clock())
        finally:
            batch.unpersist()

    return start_batches(activity, on_batch, path, checkpoint, trigger)


def _runs(rows: DataFrame, kind: str, ttl_ms: int | None) -> DataFrame:
    """One row per key and run, with its values, since when and until when it had data."""
    keys: list = list(VIEW_KEYS)
    if ttl_ms is not None:  # a row exactly ttl_ms after the one before goes on with its run
        keys.append(F.session_window(F.timestamp_millis(LAST_SEEN), f"{ttl_ms} milliseconds").alias("run"))
    runs = rows.groupBy(*keys).agg(*_merged(kind), F.min(SINCE).alias(SINCE), F.max(LAST_SEEN).alias(LAST_SEEN))
    return runs.select(*DELTAS[kind].names)


def _with_visitors(runs: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``seen`` next to the run they fall in; a run without any has a null visitor.

    Visitors are rows of their own, so a key with very many is split by the join, and counted in
    two stages behind it.
    """
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in VIEW_KEYS]
    in_run = F.col(f"s.{LAST_SEEN}") >= F.col(f"r.{SINCE}")
    joined = runs.alias("r").join(seen.alias("s"), [*same, in_run], "left")
    return joined.select(*(f"r.{k}" for k in VIEW_KEYS), "s.visitor", f"s.{LAST_SEEN}")


def live_view(
    spark: SparkSession, path: str, kind: str = "activity", ttl_ms: int | None = TTL_MS, now_ms: int | None = None
) -> DataFrame:
    """The keys that have not expired, in the layout of the batch view; with ``ttl_ms=None`` none
    ever does."""
    _check(kind)
    layout = ACTIVITY_BY_PRODUCT if kind == "activity" else VISITORS_BY_PRODUCT
    rows = read_changes(spark, f"{path}/view" if kind == "exact" else path, DELTAS[kind])
    runs = _runs(rows, kind, ttl_ms)
    if ttl_ms is not None:
        now_ms = wall_clock_ms() if now_ms is None else now_ms
        runs = runs.where(F.col(LAST_SEEN) >= now_ms - ttl_ms)
    if kind == "visitors":
        runs = runs.withColumn("unique_visitors", F.hll_sketch_estimate("sketch"))
    if kind == "exact":
        found = _with_visitors(runs, read_changes(spark, f"{path}/seen", SEEN))
        runs = found.groupBy(*VIEW_KEYS).agg(F.count_distinct("visitor").alias("unique_visitors"))
    return runs.select(*layout.names)


def compact_expiring_view(spark: SparkSession, path: str, kind: str = "activity", ttl_ms: int | None = TTL_MS) -> None:
    """Replace each run by one row, and drop the runs that had ended when the newest batch ran.

    A job of its own, beside the running query. Call it with one and the same limit, the one views
    are read with.
    """
    _check(kind)
    view = f"{path}/view" if kind == "exact" else path

    def current(rows: DataFrame) -> DataFrame:
        runs = _runs(rows, kind, ttl_ms)
        if ttl_ms is None:
            return runs
        newest = rows.agg(F.max(LAST_SEEN).alias("newest"))  # one row
        return runs.join(F.broadcast(newest), F.col(LAST_SEEN) >= F.col("newest") - ttl_ms, "left_semi")

    compact_view(spark, view, DELTAS[kind], resolve=current, carry=ttl_ms is None)
    drop_compacted(spark, view, DELTAS[kind])
    if kind != "exact":
        return

    def of_current_runs(seen: DataFrame) -> DataFrame:
        runs = current(read_changes(spark, view, DELTAS[kind]))
        known = _with_visitors(runs, seen).where("visitor is not null")
        return known.groupBy(*VIEW_KEYS, "visitor").agg(F.max(LAST_SEEN).alias(LAST_SEEN))

    # a micro-batch under way has written its visitors, but not yet its keys: leave it alone
    upto = newest_mark(spark, view)
    if upto is not None:
        compact_view(spark, f"{path}/seen", SEEN, resolve=of_current_runs, carry=ttl_ms is None, upto=upto)
    drop_compacted(spark, f"{path}/seen", SEEN)
