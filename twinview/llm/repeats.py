"""Substring dedup by windows of words: a count-min sketch first, exact groups of what is left.

Round 1: each block of documents sketches its windows. The sketch has ROWS rows of cells; a slice of
the windows' hashes has cells of its own in each, ``CELLS`` times as many as windows, so that the
sketch grows with the corpus and no part of it is ever whole in one place. Blocks send 32 bits of each
window they have, from which a slice knows its cells (twice for one that they have more than once);
slices add up and answer which windows have all cells touched twice or more: these are estimated
repeated. As cells only overestimate, no repeated window is lost.

Round 2: windows estimated repeated are asked by a longer hash, with the first document that has
them; slices group them exactly and answer which are not the first. Each block then removes the
words of windows that start earlier somewhere.

A block sends a row to each slice that it has windows of, and is answered where one is repeated. So
the rows grow with the windows at most, and they are made and read as whole columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm import blocks
from twinview.llm.arrow import SPACES, Texts, covered, releasing, spans_hashed, texts_of, window_starts, windows_hashed, words_of

WINDOW = 20
ROWS = 2
CELLS = 4
SLICE_WINDOWS = 3 << 20

SKETCH = T.StructType([T.StructField("slice", T.LongType()), T.StructField("block", T.LongType()), T.StructField("body", T.BinaryType())])
ASKED = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("slice", "block", "base")),
    *(T.StructField(c, T.BinaryType()) for c in ("keys", "second", "owners"))])
ANSWER = T.StructType([
    T.StructField("slice", T.LongType()), T.StructField("block", T.LongType()), T.StructField("round", T.IntegerType()),
    T.StructField("body", T.BinaryType())])


class _Block:
    """A block's windows: where they start and the distinct ones by hash."""

    def __init__(self, table: pa.Table, width: int):
        self.table = blocks.ordered(table)
        self.ids = blocks.ids_of(self.table)
        plain = texts_of(self.table["text"])
        # a space behind each text: every word then has one byte behind it in its text
        data = b"".join(plain.bytes_of(i) + b" " for i in range(len(plain)))
        self.texts = Texts(np.frombuffer(data, np.uint8), plain.bounds + np.arange(len(plain) + 1))
        self.words = words_of(self.texts)
        self.starts = window_starts(self.words.counts, self.words.bounds, width)
        hashes = spans_hashed(self.texts.data, self.words.starts, self.words.ends)
        # the hash's high bits are the slice and the order of everything that is sent
        self.keys, self.first, self.key_of = np.unique(
            windows_hashed(hashes, width)[self.starts], return_index=True, return_inverse=True)
        self.many = np.bincount(self.key_of, minlength=len(self.keys)) > 1
        self.hashes = hashes


def _sliced(keys: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending keys by slice: the slices that have some, where the keys of each begin and end, and
    the 32 bits of each key that follow those its slice is found by."""
    count = np.uint64(slices)
    scaled = (keys >> np.uint64(32)) * count + (((keys & np.uint64(0xFFFFFFFF)) * count) >> np.uint64(32))
    number = (scaled >> np.uint64(32)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return number[begin], np.append(begin, len(keys)), scaled.astype(np.uint32)


def _cells(values: np.ndarray, row: int, width: int) -> np.ndarray:
    """The cell of a key's 32 bits in a row of its slice's sketch."""
    part = values.astype(np.uint64)
    if row:
        part = (part * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return ((part * np.uint64(width)) >> np.uint64(32)).astype(np.int64)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of values bounds[i] to bounds[i + 1], for each i."""
    ends = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _bits(flags: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Flags bounds[i] to bounds[i + 1] as bits, for each i, from a byte's first bit on."""
    sizes = np.diff(bounds)
    ends = np.concatenate([[0], np.cumsum(-(-sizes // 8))])
    padded = np.zeros(8 * ends[-1], bool)
    padded[np.arange(len(flags)) + np.repeat(8 * ends[:-1] - bounds[:-1], sizes)] = flags
    return _binary(np.packbits(padded), ends)


def _flags(answers: pa.Table, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bits that slices ``numbers`` gave, for the keys of each; none are set where one gave no answer."""
    out = np.zeros(bounds[-1], bool)
    if answers.num_rows:
        at = np.searchsorted(numbers, answers["slice"].to_numpy())
        found = texts_of(answers["body"])
        sizes = np.diff(bounds)[at]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(bounds[at], sizes) + inner] = np.unpackbits(found.data)[np.repeat(8 * found.bounds[:-1], sizes) + inner]
    return out


def _answered(table: pa.Table, round_: int, flags: np.ndarray, bounds: np.ndarray) -> pa.Table:
    """A row (``ANSWER``) for each row of a slice's table with a flag set."""
    some = np.add.reduceat(flags, bounds[:-1], dtype=np.int64) > 0
    out = pa.table([table["slice"], table["block"], pa.array(np.full(table.num_rows, round_, np.int32)), _bits(flags, bounds)], ANSWER.names)
    return out.filter(pa.array(some))


def _sent(block: _Block, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a block sends of its windows: ``_sliced``, and the window of each entry."""
    entry = np.repeat(np.arange(len(block.keys)), 1 + block.many)
    return *_sliced(block.keys[entry], slices), entry


def _sketched(block: _Block, number: int, slices: int) -> pa.Table:
    numbers, bounds, values, _ = _sent(block, slices)
    return pa.table([pa.array(numbers), pa.array(np.full(len(numbers), number)), _binary(values, bounds)], SKETCH.names)


def _merged(table: pa.Table, width: int) -> pa.Table:
    """The sum of the blocks' sketches, as a bit for each window that a block has sent."""
    sent = texts_of(table["body"])
    values = sent.data.view("<u4")
    place, repeated = np.arange(len(values), dtype=np.int32), np.ones(len(values), bool)
    last = np.empty(width, np.int32)
    for row in range(ROWS):
        cells = _cells(values, row, width)
        last[cells] = place  # of those that touch a cell one is the last; the others show that it was touched before
        often = np.zeros(width, bool)
        often[cells[last[cells] != place]] = True
        repeated &= often[cells]
    return _answered(table, 1, repeated, sent.bounds // 4)


def _estimated(block: _Block, answers: pa.Table, slices: int) -> np.ndarray:
    """Which of a block's distinct windows are estimated to occur more than once anywhere."""
    numbers, bounds, _, entry = _sent(block, slices)
    out = np.zeros(len(block.keys), bool)
    out[entry[_flags(answers, numbers, bounds)]] = True
    return out


def _asked(block: _Block, chosen: np.ndarray, number: int, slices: int, window: int) -> pa.Table:
    """Chosen windows by slice: key, second hash and the first document that has them. Its id is 32
    bits from the block's least id on, if they suffice for the block, else its 64."""
    keys = block.keys[chosen]
    places = block.starts[block.first[chosen]]
    second = (windows_hashed(block.hashes, window, 1)[places] >> np.uint64(32)).astype(np.uint32) if len(keys) else np.zeros(0, np.uint32)
    owners = block.ids[np.searchsorted(block.words.bounds, places, "right") - 1]
    least = int(block.ids.min(initial=0))
    base, kind = (least, "<u4") if int(block.ids.max(initial=0)) - least < 1 << 32 else (0, "<i8")
    numbers, bounds, _ = _sliced(keys, slices)
    return pa.table([
        pa.array(numbers), pa.array(np.full(len(numbers), number)), pa.array(np.full(len(numbers), base)),
        _binary(keys, bounds), _binary(second, bounds), _binary((owners - base).astype(kind), bounds)], ASKED.names)


def _owners(table: pa.Table, bounds: np.ndarray) -> np.ndarray:
    """The ids of documents in asked rows, whose windows are bounds[i] to bounds[i + 1]."""
    sent, sizes = texts_of(table["owners"]), np.diff(bounds)
    halves = sent.data.view("<u4")
    parts = np.diff(sent.bounds) // 4 // sizes  # 1 or 2
    inner = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    at = np.repeat(sent.bounds[:-1] // 4, sizes) + inner * np.repeat(parts, sizes)
    out = halves[at].astype(np.uint64)
    wide = np.repeat(parts == 2, sizes)
    out[wide] |= halves[at[wide] + 1].astype(np.uint64) << np.uint64(32)
    return out.view(np.int64) + np.repeat(table["base"].to_numpy(), sizes)


def _grouped(table: pa.Table) -> pa.Table:
    """For each window asked by a block, a bit: another block's document before has it."""
    table = table.sort_by("block")  # rows of one id by block
    keys = texts_of(table["keys"])
    bounds = keys.bounds // 8
    hashes = [keys.data.view(np.uint64), texts_of(table["second"]).data.view(np.uint32)]
    return _answered(table, 2, ~blocks.first_ones(hashes, _owners(table, bounds)), bounds)


def _cleaned(block: _Block, chosen: np.ndarray, answers: pa.Table, slices: int, width: int) -> pa.Table:
    """The block's documents without the words of windows that start earlier."""
    later = np.zeros(len(block.keys), bool)
    numbers, bounds, _ = _sliced(block.keys[chosen], slices)
    later[chosen] = _flags(answers, numbers, bounds)
    words, total = block.words, len(block.words.starts)
    earlier_here = np.ones(len(block.starts), bool)
    earlier_here[block.first] = False
    removed = covered(block.starts[earlier_here | later[block.key_of]], width, total) if len(block.starts) else np.zeros(total, bool)
    counts = np.diff(np.concatenate([[0], np.cumsum(removed)])[words.bounds])

    # bytes of the words that stay, with the separator behind each
    steps = np.zeros(len(block.texts.data) + 1, np.int8)
    np.add.at(steps, words.starts[~removed], 1)
    np.add.at(steps, words.ends[~removed] + 1, -1)
    stays = np.cumsum(steps[:-1], dtype=np.int8) > 0
    data = block.texts.data[stays]
    data = np.where(SPACES[data], 0x20, data).astype(np.uint8).tobytes()
    bounds = np.concatenate([[0], np.cumsum(stays)])[block.texts.bounds]
    texts = [data[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return pa.Table.from_arrays(
        [block.table["doc"], pa.array(words.counts), pa.array(counts), pa.array(texts, pa.string())],
        ["doc", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep: list[str] | None = None, text: str = "text",
                   block_bytes: int = blocks.BLOCK_BYTES, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc`` (of the columns ``keep``, all by default), with
    n_words, n_removed and kept_text.

    A word is removed if a window of ``window`` words over it also starts earlier: in a row of
    smaller doc_id (null is smallest) or earlier in the same text. Rows of one doc_id stand in
    the order of a hash. kept_text is the words that stay, joined by one space. Null and empty
    texts, and those with fewer words than the window, lose nothing. A text longer than a block is a
    block of its own, with arrays of many times its size. No rows give no rows.
    """
    keep = docs.columns if keep is None else keep
    rows, n_blocks = blocks.deal(docs, keep, text, block_bytes)
    # six bytes a word and separator; the sketch's width needs no more than that
    slices = max(8, -(-n_blocks * block_bytes // (6 * slice_windows)))
    width = CELLS * max(1024, min(slice_windows, n_blocks * block_bytes // (6 * slices)))

    @releasing
    def sketch(key: tuple, table: pa.Table) -> pa.Table:
        return _sketched(_Block(table, window), key[0].as_py(), slices)

    @releasing
    def merge(table: pa.Table) -> pa.Table:
        return _merged(table, width)

    @releasing
    def ask(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table, window)
        return _asked(block, _estimated(block, answers, slices), key[0].as_py(), slices, window)

    @releasing
    def group(table: pa.Table) -> pa.Table:
        return _grouped(table)

    result = T.StructType([
        T.StructField("doc", rows.schema["doc"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    @releasing
    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        block, rounds = _Block(table, window), answers["round"].to_numpy()
        chosen = _estimated(block, answers.filter(pa.array(rounds == 1)), slices)
        return _cleaned(block, chosen, answers.filter(pa.array(rounds == 2)), slices, window)

    dealt = rows.groupBy("block")
    sums = dealt.applyInArrow(sketch, SKETCH).groupBy("slice").applyInArrow(merge, ANSWER)
    asked = dealt.cogroup(sums.groupBy("block")).applyInArrow(ask, ASKED)
    firsts = asked.groupBy("slice").applyInArrow(group, ANSWER)
    return dealt.cogroup(sums.unionAll(firsts).groupBy("block")).applyInArrow(finish, result)


def op5_count_min_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 20 words removed from all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, keep=["doc_id"]).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + {WINDOW - 1}), ' ') AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM texts WHERE len(words) >= {WINDOW})),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM later),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM texts),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id) LEFT JOIN rest USING (doc_id)"""
