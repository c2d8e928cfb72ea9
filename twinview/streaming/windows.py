"""Action counts of the last window of a running stream, kept pane by pane.

    <path>/panes/batch_id=<n>/    what micro-batch n adds to each key
    <path>/window/batch_id=<n>/   what the panes within the window come to, after micro-batch n

A micro-batch is a pane. The window after it is the one before, plus the pane that enters, minus those
that leave: the panes in between are not read, however many they are. A micro-batch that is
done again writes the same folders from the same ones before it. A time within the window is later
than its end less its length; the clock must not run backwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from twinview import files
from twinview.operators.views import activity_by_product
from twinview.schema import ACTIVITY_BY_PRODUCT, VIEW_KEYS
from twinview.streaming.changelog import BATCH_ID, write_changes
from twinview.streaming.expiry import wall_clock_ms
from twinview.streaming.queries import EVERY_BATCH, start_batches

# Length of the window (fixed value).
WINDOW_MS = 28_000

COUNTERS = ACTIVITY_BY_PRODUCT.names[2:]
AT = "at_ms"

PANE = T.StructType([*ACTIVITY_BY_PRODUCT, T.StructField(AT, T.LongType())])
#: Besides the values: panes that have the key, the oldest pane inside, and the time of the newest.
WINDOW = T.StructType([*ACTIVITY_BY_PRODUCT, *(T.StructField(c, T.LongType()) for c in ("panes", "oldest", AT))])


def _folder(path: str, kind: str, batch_id: int) -> str:
    return f"{path}/{kind}/changes/{BATCH_ID}={batch_id}"


def _stored(spark: SparkSession, path: str, kind: str) -> list[int]:
    found = files.glob(spark, f"{path}/{kind}/changes/{BATCH_ID}=*/_SUCCESS")
    return sorted(int(p.removesuffix("/_SUCCESS").rsplit("=", 1)[1]) for p in found)


def _read(spark: SparkSession, path: str, kind: str, batches: list[int]) -> DataFrame:
    schema = T.StructType([*(PANE if kind == "panes" else WINDOW).fields, T.StructField(BATCH_ID, T.LongType())])
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/{kind}/changes").parquet(*(_folder(path, kind, n) for n in batches))


def _signed(rows: DataFrame, panes, sign: int = 1) -> DataFrame:
    values = [(F.col(c) * sign).alias(c) for c in COUNTERS]
    return rows.select(*VIEW_KEYS, *values, panes.alias("panes"))


def _moved(spark: SparkSession, path: str, before: int | None, entering: int | None, now_ms: int, window_ms: int) -> tuple[DataFrame, int | None]:
    """The window after ``before``, moved on to ``now_ms``, with the pane ``entering``; and its oldest pane."""
    window = _read(spark, path, "window", [] if before is None else [before])
    found = window.select("oldest").first()
    inside = []
    if found is not None:
        panes = [n for n in _stored(spark, path, "panes") if found.oldest <= n <= before]
        # one time for each pane of the window
        inside = [tuple(r) for r in _read(spark, path, "panes", panes).groupBy(BATCH_ID).agg(F.max(AT)).collect()]
    leaving = [n for n, at in inside if at <= now_ms - window_ms]
    staying = [n for n, at in inside if at > now_ms - window_ms]
    one = F.lit(1).cast("long")
    rows = _signed(window, F.col("panes"))
    if entering is not None:
        rows = rows.unionAll(_signed(_read(spark, path, "panes", [entering]), one))
        staying.append(entering)
    if leaving:
        rows = rows.unionAll(_signed(_read(spark, path, "panes", leaving), -one, -1))
    sums = rows.groupBy(*VIEW_KEYS).agg(*(F.sum(c).alias(c) for c in (*COUNTERS, "panes"))).where("panes > 0")
    return sums, min(staying, default=None)


def start_window_view(
    activity: DataFrame,
    path: str,
    window_ms: int = WINDOW_MS,
    clock: Callable[[], int] = wall_clock_ms,
    checkpoint: str | None = None,
    trigger: Mapping = EVERY_BATCH,
    keep: int = 2,
) -> StreamingQuery:
    """Keep action counts of the last ``window_ms`` at ``path``; ``window_view`` reads them.

    The windows after the newest ``keep`` micro-batches stay, and the panes inside of these.
    """
    if keep < 2:
        raise ValueError("a micro-batch that is done again needs the window before it: keep 2 at least")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, now_ms = batch.sparkSession, clock()
        pane = activity_by_product(batch).withColumn(AT, F.lit(now_ms).cast("long"))
        write_changes(pane.select(*PANE.names), f"{path}/panes", batch_id)
        known = [n for n in _stored(spark, path, "window") if n < batch_id]
        window, oldest = _moved(spark, path, known[-1] if known else None, batch_id, now_ms, window_ms)
        stamped = window.withColumn("oldest", F.lit(oldest).cast("long")).withColumn(AT, F.lit(now_ms).cast("long"))
        write_changes(stamped.select(*WINDOW.names), f"{path}/window", batch_id)
        kept = [*known, batch_id][-keep:]
        first = _read(spark, path, "window", kept[:1]).select("oldest").first()
        if first is not None:  # panes of an empty window are of no use, but which they are is not known
            files.delete(spark, [_folder(path, "panes", n) for n in _stored(spark, path, "panes") if n < min(first.oldest, kept[0])])
        files.delete(spark, [_folder(path, "window", n) for n in known if n < kept[0]])

    return start_batches(activity, on_batch, path, checkpoint, trigger, ("panes", "window"))


def window_view(spark: SparkSession, path: str, window_ms: int = WINDOW_MS, now_ms: int | None = None) -> DataFrame:
    """Counts of the window that ends now: of the newest window what hasn't left it since."""
    known = _stored(spark, path, "window")
    now_ms = wall_clock_ms() if now_ms is None else now_ms
    rows, _ = _moved(spark, path, known[-1] if known else None, None, now_ms, window_ms)
    return rows.select(*ACTIVITY_BY_PRODUCT.names)


def window_history(spark: SparkSession, path: str) -> DataFrame:
    """The stored windows below each other, each with the time of its newest pane."""
    rows = _read(spark, path, "window", _stored(spark, path, "window"))
    return rows.select(AT, *ACTIVITY_BY_PRODUCT.names)
