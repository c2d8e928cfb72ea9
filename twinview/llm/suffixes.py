"""Suffix-array dedup: repeated strings of bytes found by external induced sorting of shards.

The suffixes of a corpus can't be sorted in one place. Every string of ``length`` bytes has an
anchor, the least hash of the ``GRAM``-byte strings in it; equal strings have equal anchors, and
neighbouring strings mostly share one. So a text is a row of runs, each of strings with one anchor.

Round 1: blocks of documents list their anchors as plain rows, and those of several blocks come back.
Round 2: the runs of such anchors go to the anchor's slice as they are, a row for each distinct run
of a block. A slice is a shard: runs that equal an earlier one are repeated as a whole, and where
an anchor has different runs, these are one text whose suffixes are sorted with their common
prefixes (``induced``). Suffixes that share ``length`` bytes are one string; all but the first in the
order of documents are repeated. Blocks are told which strings of their runs are, and cut them out.
Rows grow with the texts, whatever the number of blocks and slices.

A shard's runs and their columns are written to scratch space as they arrive, and the sort keeps to
a bound of memory; a shard may be far larger. In memory are some numbers for each run of a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm import blocks
from twinview.llm.arrow import mixed, release, releasing, spans_hashed, texts_of
from twinview.llm.induced import MEMORY_BYTES, Scratch, Sorter

LENGTH = 100
GRAM = 32
SLICE_BYTES = 8 << 20  # of texts, for each slice of the anchors
_CACHED = 1 << 15
_SPOT_BITS = np.uint64(24)
_SPOT = np.uint64((1 << 24) - 1)
_RUNS = 1 << 14  # in one Arrow table or batch

ANCHOR = T.StructType([T.StructField("key", T.LongType()), T.StructField("block", T.LongType())])
RUN = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("slice", "key", "hash", "block", "owner", "place")),
    T.StructField("again", T.BooleanType()), T.StructField("body", T.BinaryType())])
ANSWER = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("place", T.LongType()), T.StructField("state", T.IntegerType()),
    T.StructField("later", T.BinaryType())])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the ``length`` bytes at each byte: the least hash (40 bits) of the ``gram`` bytes at places
    in them, and the place (24 bits), of equal ones the leftmost. ``gram`` is 8, 16, 32 and so on.

    Worked on in parts that stay in the processor's cache.
    """
    total, width = len(data) - length + 1, length - gram + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    out = np.empty(total, np.uint64)
    with np.errstate(over="ignore"):
        for first in range(0, total, _CACHED):
            n = min(_CACHED, total - first)
            hashes, size = lanes[first : first + n + length - 1].copy(), 8
            hashes *= np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(32)
            while size < gram:
                hashes = hashes[:-size] * np.uint64(0xD6E8FEB86659FD93) + hashes[size:]
                size *= 2
            hashes = hashes[: n + width - 1]
            hashes ^= hashes >> np.uint64(32)
            hashes *= np.uint64(0xC2B2AE3D27D4EB4F)
            hashes &= ~_SPOT
            hashes |= np.arange(first, first + len(hashes), dtype=np.uint64) & _SPOT
            out[first : first + n] = _least(hashes, width)
    return out >> _SPOT_BITS, out & _SPOT


class _Block:
    """A block's texts as runs of strings with one anchor: strings first[i] to stop[i] (their
    first bytes), by anchor key[i]."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        self.table, self.length = blocks.ordered(table), length
        self.ids = blocks.ids_of(self.table)
        self.texts = texts_of(self.table["text"])
        data, bounds = self.texts.data, self.texts.bounds
        last = np.maximum(bounds[1:] - length + 1, bounds[:-1])  # past the last string of each text
        if len(data) < length:
            self.first = self.stop = self.owner = np.zeros(0, np.int64)
            self.key, self.again = np.zeros(0, np.uint64), np.zeros(0, bool)
            return
        anchors, spots = _anchors(data, length, gram)
        new = np.concatenate([[True], anchors[1:] != anchors[:-1]])
        new[bounds[:-1][bounds[:-1] < len(new)]] = True
        inside = np.zeros(len(new) + 1, np.int8)
        some = last > bounds[:-1]
        np.add.at(inside, bounds[:-1][some], 1)
        np.add.at(inside, last[some], -1)
        self.first = np.flatnonzero(new & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
        self.owner = np.searchsorted(bounds, self.first, "right") - 1
        self.stop = np.minimum(np.append(self.first[1:], len(data)), last[self.owner])
        self.key = mixed(anchors[self.first], 3) >> _SPOT_BITS  # least hashes are small: spread over the slices
        # equal strings have their anchor in one place, so a run has one twice only if its anchor moves
        self.again = (spots[self.first] != spots[self.stop - 1]) | (len(data) > int(_SPOT))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, ascending, and whether the block has them more than once."""
        short = np.sort(self.key)
        new = np.concatenate([[True], short[1:] != short[:-1]]) if len(short) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        return short[at], np.diff(np.append(at, len(short))) > 1

    def repeated(self, answers: pa.Table) -> np.ndarray:
        """Runs that may hold a string that is also elsewhere or in them twice, by position."""
        short, many = self.anchors()
        many |= np.isin(short, answers["key"].to_numpy().view(np.uint64), assume_unique=True)
        return np.flatnonzero(many[np.searchsorted(short, self.key)] | self.again) if len(short) else np.zeros(0, np.int64)

    def distinct(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of equal runs, and their hashes."""
        hashes = spans_hashed(self.texts.data, self.first[runs], self.stop[runs] + self.length - 1, 2)
        hashes, first = np.unique(mixed(hashes ^ self.key[runs], 1), return_index=True)
        return runs[first], hashes


def _asked_runs(block: _Block, number: int, slices: int, answers: pa.Table) -> pa.Table:
    """A row (``RUN``) for each distinct run that may hold a repeated string."""
    runs, hashes = block.distinct(block.repeated(answers))
    data, out = block.texts.data, [blocks.empty(RUN)]
    for a in range(0, len(runs), _RUNS):
        own = runs[a : a + _RUNS]
        size = block.stop[own] - block.first[own] + block.length - 1
        bounds = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(block.first[own] - bounds[:-1], size) + np.arange(bounds[-1])
        body = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[where])])
        key = block.key[own]
        columns = [(key * np.uint64(slices)) >> np.uint64(40), key, hashes[a : a + _RUNS], np.full(len(own), number), block.ids[block.owner[own]], block.first[own]]
        out.append(pa.Table.from_arrays([*(pa.array(c.view(np.int64)) for c in columns), pa.array(block.again[own]), body], RUN.names))
    return pa.concat_tables(out)


class _Shard:
    """The runs of a slice, as they arrive, in scratch space."""

    def __init__(self, memory_bytes: int):
        self.scratch = Scratch(memory_bytes)
        self.parts: list[list[np.ndarray]] = []

    def add(self, batch: pa.RecordBatch) -> None:
        texts = texts_of(batch["body"])
        columns = [batch[c].to_numpy() for c in ("key", "hash", "block", "owner", "place")]
        columns += [batch["again"].to_numpy(zero_copy_only=False), np.diff(texts.bounds), texts.data]
        self.parts.append([self.scratch.keep(c) for c in columns])

    def _column(self, i: int) -> np.ndarray:
        out = self.scratch.array(sum(len(p[i]) for p in self.parts), self.parts[0][i].dtype)
        np.concatenate([p[i] for p in self.parts], out=out)
        if i != 6:  # sizes are asked for by part again
            for p in self.parts:
                self.scratch.free(p[i])
                p[i] = p[i][:0].copy()
        return out

    def answers(self, length: int) -> Iterator[pa.RecordBatch]:
        """A row (``ANSWER``) for each run. state 0: no string of it starts earlier, 1: all, 2: those
        of the bit map."""
        if not self.parts:
            return
        key, hashes, number, owner, place, again, size = (self._column(i) for i in range(7))
        by = np.lexsort((number, owner))  # the order of documents; rows of one id by block
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(np.concatenate([[False], (owner[by][1:] != owner[by][:-1]) | (number[by][1:] != number[by][:-1])]))
        first = blocks.first_ones([hashes, key], rank * (int(place.max()) + 1) + place)
        state = np.where(first, 0, 1).astype(np.int32)

        # anchors with different runs
        lead = np.flatnonzero(first)
        lead = lead[np.argsort(key[lead], kind="stable")]
        alike = key[lead][1:] == key[lead][:-1]
        mixed_ = lead[np.concatenate([[False], alike]) | np.concatenate([alike, [False]])] if len(lead) else lead
        chosen = np.union1d(mixed_, lead[again[lead]])
        later, begin = self._sorted(chosen, rank, place, size, length)
        state[chosen] = 2

        for a in range(0, len(state), _RUNS):
            b = min(a + _RUNS, len(state))
            maps: list[bytes | None] = [None] * (b - a)
            for j in range(*np.searchsorted(chosen, [a, b])):
                i = chosen[j]
                maps[i - a] = np.packbits(later[begin[j] : begin[j] + size[i] - length + 1]).tobytes()
            yield pa.record_batch([pa.array(number[a:b]), pa.array(place[a:b]), pa.array(state[a:b]), pa.array(maps, pa.binary())], ANSWER.names)

    def _sorted(self, chosen: np.ndarray, rank: np.ndarray, place: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which strings of the chosen runs start earlier in another or in itself, and where each run begins in that."""
        if not len(chosen):
            return np.zeros(0, bool), np.zeros(1, np.int64)
        begin = np.concatenate([[0], np.cumsum(size[chosen] + 1)])
        text = self.scratch.array(int(begin[-1]), np.uint8)
        ends = np.cumsum([len(p[6]) for p in self.parts])
        part_of = np.searchsorted(ends, chosen, "right")
        for i, part in enumerate(self.parts):
            inner = np.concatenate([[0], np.cumsum(part[6])])
            for j in np.flatnonzero(part_of == i).tolist():
                at = chosen[j] - (ends[i] - len(part[6]))
                text[begin[j] : begin[j + 1] - 1] = part[7][inner[at] : inner[at + 1]] + 1
        # strings in the order of documents and places
        span = int((place[chosen] + size[chosen]).max()) + 1
        base = rank[chosen] * span + place[chosen]
        later = self.scratch.array(len(text), bool)
        least, held = -1, -1  # of the group of equal strings that goes on
        for positions, common in Sorter(text, length, self.scratch).descending():
            group = np.cumsum(common < length) - 1  # -1: goes on from the batch before
            run = np.searchsorted(begin, positions, "right") - 1
            order = base[run] + positions - begin[run]
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            lows = np.minimum.reduceat(order, edges)
            counts = np.diff(np.append(edges, len(group)))
            goes_on = group[0] == -1 and least < lows[0]
            if goes_on:
                lows[0] = least
            elif group[0] == -1:
                later[held] = True
            behind = order > np.repeat(lows, counts)
            later[positions[behind]] = True
            if len(edges) > 1 or not goes_on:
                tail = np.arange(edges[-1], len(group))
                held = int(positions[tail[np.argmin(order[tail])]])
            least = int(lows[-1])
        return later, begin


def _cut(block: _Block, answers: pa.Table, as_text: bool = False) -> pa.Table:
    """The block's documents without the bytes of strings that start earlier."""
    data, bounds, length = block.texts.data, block.texts.bounds, block.length
    asked = np.searchsorted(block.first, answers["place"].to_numpy())
    said = answers["state"].to_numpy()
    # a run with a key that was asked, but not itself: equal to one before it in this block
    state = np.isin(block.key, block.key[asked]).astype(np.int32)
    state[asked] = said
    steps = np.zeros(len(data) + 1, np.int64)
    whole = np.flatnonzero(state == 1)
    np.add.at(steps, block.first[whole], 1)
    np.add.at(steps, block.stop[whole] + length - 1, -1)
    mapped = np.flatnonzero(said == 2)
    for i, body in zip(asked[mapped].tolist(), answers["later"].take(pa.array(mapped)).to_pylist()):
        later = np.unpackbits(np.frombuffer(body, np.uint8), count=int(block.stop[i] - block.first[i]))
        starts = block.first[i] + np.flatnonzero(later)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + length, -1)
    gone = np.cumsum(steps[:-1]) > 0
    kept = np.concatenate([[0], np.cumsum(~gone)])[bounds]
    rest = data[~gone].tobytes()

    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    edge[edges] = gone[edges]
    stop = gone.copy()
    stop[:-1] &= ~gone[1:]
    inner = bounds[1:][bounds[1:] > 0] - 1
    stop[inner] = gone[inner]
    starts, ends = np.flatnonzero(edge), np.flatnonzero(stop) + 1
    per = np.searchsorted(starts, bounds)
    owner = np.repeat(np.arange(len(per) - 1), np.diff(per))
    spans = pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), pa.StructArray.from_arrays(
        [pa.array(starts - bounds[owner]), pa.array(ends - bounds[owner])], ["start", "end"]))
    parts = (rest[a:b] for a, b in zip(kept[:-1].tolist(), kept[1:].tolist()))
    column = pa.array([p.decode(errors="ignore") for p in parts], pa.string()) if as_text else pa.array(list(parts), pa.binary())
    return pa.Table.from_arrays(
        [block.table["doc"], pa.array(np.diff(bounds)), pa.array(np.diff(bounds) - np.diff(kept)), spans, column],
        ["doc", "n_bytes", "n_removed", "spans", "kept"])


def cut_repeats(docs: DataFrame, length: int = LENGTH, keep: list[str] | None = None, text: str = "text", gram: int = GRAM,
                block_bytes: int = blocks.BLOCK_BYTES, slice_bytes: int = SLICE_BYTES, memory_bytes: int = MEMORY_BYTES,
                as_text: bool = False) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc`` (of the columns ``keep``, all by default), with
    n_bytes and n_removed of its text in UTF-8, the removed spans (start, end) and the bytes kept
    (``as_text``: as a string, without the rests of characters that a cut goes through).

    A byte is removed if a string of ``length`` bytes over it also starts earlier: in a row of
    smaller doc_id (null is smallest) or earlier in the same text. Rows of one doc_id stand in
    the order of a hash. Cuts may fall inside a character. Null, empty and shorter texts lose
    nothing. A text longer than a block is a block of its own, with arrays of many times its size. No rows
    give no rows.
    """
    keep = docs.columns if keep is None else keep
    rows, n_blocks = blocks.deal(docs, keep, text, block_bytes)
    slices = max(8, -(-n_blocks * block_bytes // slice_bytes))

    @releasing
    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        short, _ = _Block(table, length, gram).anchors()
        return pa.Table.from_arrays([pa.array(short.view(np.int64)), pa.array(np.full(len(short), key[0].as_py()))], ANCHOR.names)

    @releasing
    def ask(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        return _asked_runs(_Block(table, length, gram), key[0].as_py(), slices, answers)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(memory_bytes)
        for batch in batches:
            shard.add(batch)
        yield from shard.answers(length)
        del shard
        release()

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    result = T.StructType([
        T.StructField("doc", rows.schema["doc"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.StringType() if as_text else T.BinaryType())])

    @releasing
    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _cut(_Block(table, length, gram), answers, as_text)

    dealt = rows.groupBy("block")
    # a block has an anchor once in this: one of a third of all texts is a row a block
    listed = dealt.applyInArrow(anchors, ANCHOR).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    often = listed.where("n > 1").select("block", "key")
    asked = dealt.cogroup(often.groupBy("block")).applyInArrow(ask, RUN)
    answers = asked.groupBy("slice").applyInArrow(sort, ANSWER)
    return dealt.cogroup(answers.groupBy("block")).applyInArrow(finish, result)


def op9_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes cut out of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return cut_repeats(docs, keep=["doc_id"]).select(
        "doc.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
strings AS (
  SELECT doc_id, i, substr(digits, 2 * i - 1, 200) AS s
  FROM (SELECT doc_id, digits, unnest(generate_series(1, length(digits) // 2 - 99)) AS i FROM texts WHERE length(digits) >= 200)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM strings) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 99)) AS p FROM later),
spans AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (p - before > 1 OR before IS NULL) AS runs
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id),
bytes AS (SELECT doc_id, digits, unnest(generate_series(1, length(digits) // 2)) AS p FROM texts),
rest AS (SELECT doc_id, string_agg(substr(digits, 2 * p - 1, 2), '' ORDER BY p) AS kept FROM bytes ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, (length(digits) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN spans USING (doc_id) LEFT JOIN rest USING (doc_id)"""
