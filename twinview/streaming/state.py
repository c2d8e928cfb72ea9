"""Keyed state with a time limit, kept by Spark's state store (RocksDB).

``start_state_view`` runs a state function on every key of a micro-batch. A key without new data for
more than the limit starts over; its state is dropped by the store itself some time after the limit
has passed on the machine's clock, without a reader or a compaction job. ``state_view`` reads all live
keys from the running query's checkpoint, with Spark's reader of state stores; there is no other table.

Clicks are combined by key in each task before they are shuffled, some hundred thousand at a time, so a
product with a third of all clicks reaches its state as some rows a task. Exact visitors are spread over
``SHARDS`` keys for each product and bucket by a hash of the visitor; every shard hears of every
micro-batch that has data of its key, so that all of them start over at the same time. A shard's visitors
come as lists and are stored in pages of a map state, as each call of the state store is a message between
Python and Spark: there is one for each page that a micro-batch touches, not one for each visitor.

Such a query keeps running micro-batches while there is no data, as time alone changes its state:
give it an interval to run at, and stop it with ``stop_after``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from twinview.schema import ACTIVITY_BY_PRODUCT, ADD_TO_CART, PAGE_VIEW, PURCHASE, VIEW_KEYS, VISITORS_BY_PRODUCT
from twinview.session import state_settings
from twinview.streaming.expiry import TTL_MS, wall_clock_ms
from twinview.streaming.queries import EVERY_BATCH

#: Keys that the visitors of a product and bucket are spread over. A running query's number stays.
SHARDS = 8

#: Visitors that a page holds in the mean, when the pages of a shard are full.
PAGE = 64

#: Clicks and bytes that a task combines at a time, and visitors of one row of it.
COMBINED_ROWS, COMBINED_BYTES, LISTED = 1 << 18, 64 << 20, 256

NOW = "now_ms"
COUNTERS = ACTIVITY_BY_PRODUCT.names[2:]
_VALUE, _SEEN = "totals", "seen"


def _arrow_schema(names: tuple[str, ...]) -> str:
    kinds = {"product": "string", "visitors": "array<string>", "shard": "int"}
    return ", ".join(f"{name} {kinds.get(name, 'long')}" for name in names)


class Counts(StatefulProcessor):
    """Action counts of a key since it last started over, in one value."""

    rows = (*VIEW_KEYS, *COUNTERS, NOW)
    out = (*VIEW_KEYS, *COUNTERS)
    keys = VIEW_KEYS

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        state = f"{', '.join(f'{name} long' for name in COUNTERS)}, last_seen_ms long"
        self.totals = handle.getValueState(_VALUE, state, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added, now = [0] * len(COUNTERS), None
        for row in rows:
            added = [a + row[name] for a, name in zip(added, COUNTERS)]
            now = row[NOW] if now is None else max(now, row[NOW])
        before = self.totals.get()
        if before is not None and now - before[-1] <= self.ttl_ms:
            added = [a + b for a, b in zip(added, before)]
        self.totals.update((*added, now))
        yield Row(**dict(zip(self.out, (*key, *added))))


def _page(code: int, pages: int) -> int:
    """The page of a hash code among so many pages. With one page more, one of them is dealt to two."""
    mask = (1 << (pages - 1).bit_length()) - 1
    page = code & mask
    return page if page < pages else page & (mask >> 1)


def _by_page(visitors: set[str], pages: int) -> dict[int, set[str]]:
    found: dict[int, set[str]] = {}
    for visitor in visitors:
        found.setdefault(_page(zlib.crc32(visitor.encode()), pages), set()).add(visitor)
    return found


class Visitors(StatefulProcessor):
    """Distinct visitors of a key's shard since it last started over, in pages of a map.

    The pages grow in number with the visitors (linear hashing), so a page stays small, and a
    micro-batch reads and writes only pages that its own visitors belong to or that are split.
    The number of visitors is kept beside the map, which is never read as a whole. A timer drops both;
    it is set once, and again when it comes up too early.
    """

    rows = (*VIEW_KEYS, "shard", "visitors", NOW)
    out = (*VIEW_KEYS, "shard", "unique_visitors")
    keys = (*VIEW_KEYS, "shard")

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState(_VALUE, "unique_visitors long, last_seen_ms long, written_ms long, pages int")
        self.seen = handle.getMapState(_SEEN, "page int", "visitors array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        visitors, now = set(), None
        for row in rows:
            now = row[NOW] if now is None else max(now, row[NOW])
            visitors.update(row["visitors"])
        before, written = self.totals.get(), timerValues.getCurrentProcessingTimeInMs()
        count = pages = 0
        if before is not None and now - before[1] <= self.ttl_ms:
            count, pages = before[0], before[3]
        elif before is not None and before[3]:
            self.seen.clear()
        if before is not None or visitors or key[-1] == 0:  # else the first shard alone knows of the key
            if before is None:
                self.handle.registerTimer(written + self.ttl_ms + 1)
            needed = max(pages, -(-(count + len(visitors)) // PAGE))
            count += self._add(visitors, pages, needed)
            self.totals.update((count, now, written, needed))
        yield Row(**dict(zip(self.out, (*key, count))))

    def _add(self, visitors: set[str], pages: int, needed: int) -> int:
        """Add visitors to a map of so many pages, which gets those needed; returns how many are new."""
        if not pages:  # the map is empty
            for page, some in _by_page(visitors, needed).items():
                self.seen.updateValue((page,), (list(some),))
            return len(visitors)
        added, coming = 0, _by_page(visitors, pages)
        for page in {*coming, *(_page(new, pages) for new in range(pages, needed))}:
            stored = self.seen.getValue((page,))
            known = set(stored[0]) if stored is not None else set()
            fresh = coming.get(page, set()) - known
            added += len(fresh)
            parts = _by_page(known | fresh, needed) if needed > pages else {page: known | fresh}
            for part, some in parts.items():
                if part != page or some != known:
                    self.seen.updateValue((part,), (list(some),))
            if known and page not in parts:
                self.seen.removeKey((page,))
        return added

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before = self.totals.get()
        until = before[2] + self.ttl_ms + 1 if before is not None else 0
        if until > timerValues.getCurrentProcessingTimeInMs():
            self.handle.registerTimer(until)
        else:
            self.seen.clear()
            self.totals.clear()
        yield from ()


KINDS = {"activity": Counts, "exact": Visitors}


def _processor(kind: str) -> type:
    if kind not in KINDS:
        raise ValueError(f"kind is one of {', '.join(KINDS)}, not {kind!r}")
    return KINDS[kind]


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task as tables of a bounded size."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= COMBINED_ROWS or size >= COMBINED_BYTES:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def _combined_counts(activity: DataFrame) -> DataFrame:
    counters = [F.when(F.col("action") == action, 1).otherwise(0).cast("long").alias(name)
                for action, name in zip((PURCHASE, ADD_TO_CART, PAGE_VIEW), COUNTERS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            sums = table.group_by([*VIEW_KEYS, NOW]).aggregate([(name, "sum") for name in COUNTERS])
            yield from sums.select([*VIEW_KEYS, *(f"{name}_sum" for name in COUNTERS), NOW]).rename_columns(list(Counts.rows)).to_batches()

    return activity.select(*VIEW_KEYS, *counters, NOW).mapInArrow(run, _arrow_schema(Counts.rows))


def _listed(table: pa.Table) -> pa.Table:
    """A row for each key and each of its shards, with its distinct visitors; more rows if they are many."""
    present = table.select([*VIEW_KEYS, NOW]).group_by(list(VIEW_KEYS)).aggregate([(NOW, "max")]).rename_columns([*VIEW_KEYS, NOW])
    each = present.take(pa.array(np.repeat(np.arange(present.num_rows), SHARDS)))
    each = each.append_column("shard", pa.array(np.tile(np.arange(SHARDS, dtype=np.int32), present.num_rows)))
    each = each.append_column("visitor", pa.nulls(each.num_rows, pa.string()))
    each = each.select([*Visitors.keys, "visitor", NOW])
    rows = pa.concat_tables([table.select(each.column_names).cast(each.schema), each])  # where no nulls are, types say so
    lists = rows.group_by(list(Visitors.keys)).aggregate([("visitor", "distinct"), (NOW, "max")])  # without nulls
    lists = lists.select([*Visitors.keys, "visitor_distinct", f"{NOW}_max"]).rename_columns(list(Visitors.rows)).combine_chunks()
    visitors = pa.concat_arrays(lists["visitors"].chunks)
    lengths = visitors.value_lengths().to_numpy()
    parts = np.maximum(1, -(-lengths // LISTED))
    row = np.repeat(np.arange(len(lengths)), parts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = (np.cumsum(lengths) - lengths)[row] + nth * LISTED
    offsets = pa.array(np.append(starts, lengths.sum()), pa.int32())
    column = pa.ListArray.from_arrays(offsets, visitors.flatten())
    split = lists.drop_columns(["visitors"]).take(pa.array(row))
    return split.append_column("visitors", column).select(list(Visitors.rows))


def _combined_visitors(activity: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            yield from _listed(table).to_batches()

    # a null visitor has a hash, too: its row stays in that shard and adds nothing
    shard = F.pmod(F.xxhash64("visitor"), F.lit(SHARDS)).cast("int").alias("shard")
    return activity.select(*VIEW_KEYS, shard, "visitor", NOW).mapInArrow(run, _arrow_schema(Visitors.rows))


def keyed_state(activity: DataFrame, kind: str = "activity", ttl_ms: int = TTL_MS, now: Column | None = None) -> DataFrame:
    """The changed keys of every micro-batch with their values: action counts ("activity") or exact
    visitors ("exact", a row for each shard).

    ``now``: the time in milliseconds that the limit is measured by, from columns of ``activity``; the
    micro-batch's own time unless given. It must not run backwards. A null product or bucket is
    a key like any other, a null visitor counts as none.
    """
    processor = _processor(kind)
    clock = F.unix_millis(F.current_timestamp()) if now is None else now.cast("long")
    rows = activity.withColumn(NOW, clock)
    rows = _combined_counts(rows) if kind == "activity" else _combined_visitors(rows)
    return rows.groupBy(*processor.keys).transformWithState(
        processor(ttl_ms), T._parse_datatype_string(_arrow_schema(processor.out)), "update", "processingTime")


def start_state_view(
    activity: DataFrame,
    checkpoint: str,
    kind: str = "activity",
    ttl_ms: int = TTL_MS,
    now: Column | None = None,
    trigger: Mapping = EVERY_BATCH,
) -> StreamingQuery:
    """Keep the view as state below ``checkpoint``, the only thing written; ``state_view`` reads it."""
    with state_settings(activity.sparkSession):
        changed = keyed_state(activity, kind, ttl_ms, now)
        return (changed.writeStream.outputMode("update").format("noop")
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def state_view(
    spark: SparkSession, checkpoint: str, kind: str = "activity", ttl_ms: int = TTL_MS, now_ms: int | None = None
) -> DataFrame:
    """All keys alive after the last committed micro-batch, in the layout of the batch view.

    Read from the state store of a running or stopped query. ``now_ms``: the time to judge by, the
    machine's own unless given.
    """
    processor = _processor(kind)
    stored = spark.read.format("statestore").option("stateVarName", _VALUE).load(checkpoint)
    value = "value.value" if "value" in stored.schema["value"].dataType.names else "value"  # with a limit there is one level more
    now_ms = wall_clock_ms() if now_ms is None else now_ms
    live = stored.where(F.col(f"{value}.last_seen_ms") >= now_ms - ttl_ms)
    keys = [F.col(f"key.{name}").alias(name) for name in VIEW_KEYS]
    if kind == "activity":
        return live.select(*keys, *(F.col(f"{value}.{name}").alias(name) for name in COUNTERS)).select(*ACTIVITY_BY_PRODUCT.names)
    shards = live.select(*keys, F.col(f"{value}.unique_visitors").alias("unique_visitors"))
    return shards.groupBy(*VIEW_KEYS).agg(F.sum("unique_visitors").alias("unique_visitors")).select(*VISITORS_BY_PRODUCT.names)


def aggregate_state(spark: SparkSession, checkpoint: str, names: list[str]) -> DataFrame:
    """All keys of a running aggregation (``activity_view_stream``, ``exact_visitors_stream`` without
    ``distinct``) from its state store, its values named ``names``: a snapshot without a changelog."""
    stored = spark.read.format("statestore").load(checkpoint)
    keys = [F.col("key")[name].alias(name) for name in stored.schema["key"].dataType.names]
    fields = stored.schema["value"].dataType.fields  # by place: sums are all named alike
    renamed = T.StructType([T.StructField(name, f.dataType) for name, f in zip(names, fields, strict=True)])
    return stored.select(*keys, F.col("value").cast(renamed).alias("value")).select(*stored.schema["key"].dataType.names, "value.*")
