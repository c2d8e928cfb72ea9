"""Streaming queries: start, publish, stop.

A query's checkpoint lies in ``_checkpoint`` below the table it writes (the master dataset's beside
it, as it is read by its folders), unless given: table and checkpoint belong together, and one
must not be kept without the other.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from twinview import files
from twinview.operators.reports import register
from twinview.schema import VIEW_KEYS
from twinview.session import state_settings
from twinview.sinks import append_master
from twinview.sources.merges import write_ends
from twinview.streaming.changelog import (
    compact_view,
    drop_batches,
    drop_compacted,
    latest_view,
    write_changes,
)

# Micro-batch interval and interval at which views are saved (fixed values).
EVERY_BATCH = {"processingTime": "4 seconds"}
EVERY_SNAPSHOT = {"processingTime": "28 seconds"}

#: Micro-batches after which a published view with keys is compacted.
COMPACT_EVERY = 64


def start_batches(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    path: str,
    checkpoint: str | None,
    trigger: Mapping,
    tables: Sequence[str] = (),
    mode: str = "update",
) -> StreamingQuery:
    """Run ``on_batch`` on every micro-batch.

    A checkpoint of its own would number the micro-batches from 0 again, below those already in the
    table, so a table of another query is refused. ``tables``: folders of tables below the path.
    """
    spark, checkpoint = stream.sparkSession, checkpoint or f"{path}/_checkpoint"
    used = any(files.exists(spark, f"{path}/{name}") for name in ("changes", "base", "view", *tables))
    if used and not files.exists(spark, checkpoint):
        raise ValueError(f"{path} has a table, but {checkpoint} is not its checkpoint")
    with state_settings(spark):
        return (
            stream.writeStream.outputMode(mode).foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger).start()
        )


def writer_of(checkpoint: str) -> str:
    """A name for the query with this checkpoint, the same after a restart."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def append_master_stream(
    flat: DataFrame, path: str, checkpoint: str | None = None, trigger: Mapping = EVERY_BATCH
) -> StreamingQuery:
    """Append flattened activities to the master dataset, each exactly once.

    Micro-batches write as batch jobs do (``append_master``), so both may append to one dataset.
    """
    checkpoint = checkpoint or f"{path.rstrip('/')}_checkpoint"
    writer = writer_of(checkpoint)

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            append_master(rows, path, f"{writer}-{batch_id}")
            write_ends(rows, path, f"{writer}-{batch_id}")
        finally:
            rows.unpersist()

    return flat.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def upsert_view(
    view: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: Mapping = EVERY_SNAPSHOT,
) -> StreamingQuery:
    """Save the changed rows of a running view; ``latest_view`` reads it back, and ``compact_view``
    should be run now and then."""
    return start_batches(view, lambda changes, batch_id: write_changes(changes, path, batch_id), path, checkpoint, trigger)


def append_view(
    closed: DataFrame, path: str, checkpoint: str | None = None, trigger: Mapping = EVERY_SNAPSHOT
) -> StreamingQuery:
    """Save the rows of a view that never change again (``closed_activity_view``), each once;
    ``read_changes`` reads them back."""
    return start_batches(
        closed, lambda rows, batch_id: write_changes(rows, path, batch_id), path, checkpoint, trigger, mode="append")


def publish_view(
    stream: DataFrame,
    name: str,
    path: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    keys: Sequence[str] | None = None,
    cache: bool = False,
    checkpoint: str | None = None,
    trigger: Mapping = EVERY_BATCH,
) -> StreamingQuery:
    """Keep SQL table ``name`` of the caller's session at the result of the newest micro-batch.

    ``transform`` is applied to each micro-batch on its own. With ``keys`` the table holds the last
    row per key of all micro-batches, else the rows of the newest one. The rows are stored below
    ``path``; the table reads them from there. Without new data the table stays as it is. With ``keys``
    every ``COMPACT_EVERY``-th micro-batch compacts what is stored, so that the table reads a base and
    a bounded number of micro-batches.
    """
    spark = stream.sparkSession

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        result = transform(rows) if transform else rows
        write_changes(result, path, batch_id)
        if keys:
            if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
                compact_view(spark, path, result.schema, keys)
                drop_compacted(spark, path, result.schema)
            table = latest_view(spark, path, result.schema, keys)
        else:
            table = spark.read.schema(result.schema).parquet(f"{path}/changes/batch_id={batch_id}")
        if cache and spark.catalog.tableExists(name):
            spark.catalog.uncacheTable(name)
        register(table, name, cache)
        if not keys:
            drop_batches(spark, path, before=batch_id - 1)

    return start_batches(stream, on_batch, path, checkpoint, trigger)


def await_for(query: StreamingQuery, seconds: float) -> bool:
    """Wait for a query to end; False if it has not ended in time."""
    return bool(query.awaitTermination(seconds))


def stop_when_idle(query: StreamingQuery, seconds: float = 60.0) -> bool:
    """Stop a query between two micro-batches; after ``seconds`` at the latest.

    Returns whether it was idle. A micro-batch cut off is done again when the query restarts.
    """
    deadline = time.monotonic() + seconds
    idle = False
    while query.isActive and not idle and time.monotonic() < deadline:
        status = query.status
        idle = not status["isTriggerActive"] and not status["isDataAvailable"]
        if not idle:
            time.sleep(0.1)
    query.stop()
    return idle
