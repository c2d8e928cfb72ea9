"""The speed job: one stream of clicks to the master dataset and the two running views."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from twinview.functions import HOUR_MS
from twinview.operators import flatten_props, parse_activity, with_source_props
from twinview.sinks import append_master
from twinview.sources.merges import write_ends
from twinview.streaming.expiry import append_batch, wall_clock_ms
from twinview.streaming.queries import EVERY_BATCH, start_batches, writer_of

# Names of the views below the views' path (fixed values).
ACTIVITY_VIEW, VISITORS_VIEW = "stream_activity_by_product", "stream_visitors_by_product"


def start_pipeline(
    lines: DataFrame,
    master_path: str,
    views_path: str,
    bucket_ms: int = HOUR_MS,
    clock: Callable[[], int] = wall_clock_ms,
    checkpoint: str | None = None,
    trigger: Mapping = EVERY_BATCH,
) -> StreamingQuery:
    """Start the one query that feeds all three.

    ``lines`` has ``value`` and ``inputProps``, or in place of these ``topic``, ``partition`` and
    ``offset``: then the offset range of a line is what its micro-batch holds of its Kafka partition,
    found on the micro-batch as it is kept, without reading it again. A micro-batch is read and
    parsed once and kept for its three writers; each replaces what an earlier try of it wrote. ``live_view``
    reads the views ("activity" and "visitors"): keys idle for its limit, two hours unless given,
    have expired.
    """
    checkpoint = checkpoint or f"{views_path}/_checkpoint"
    writer = writer_of(checkpoint)

    ranged = "inputProps" not in lines.columns

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        now_ms, name = clock(), f"{writer}-{batch_id}"
        batch.persist()
        activity = parse_activity(with_source_props(batch), bucket_ms).persist() if ranged else batch
        try:
            flat = flatten_props(activity)
            append_master(flat, master_path, name)
            write_ends(flat, master_path, name)
            append_batch(activity, f"{views_path}/{ACTIVITY_VIEW}", batch_id, "activity", now_ms)
            append_batch(activity, f"{views_path}/{VISITORS_VIEW}", batch_id, "visitors", now_ms)
        finally:
            activity.unpersist()
            batch.unpersist()

    tables = (f"{ACTIVITY_VIEW}/changes", f"{VISITORS_VIEW}/changes")
    rows = lines if ranged else parse_activity(lines, bucket_ms)
    return start_batches(rows, on_batch, views_path, checkpoint, trigger, tables)
