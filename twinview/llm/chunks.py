"""SentencePiece encoding and decoding by a table of distinct marked words.

No piece of the model crosses from a word into the next word's mark, so a text's pieces are those
of its marked words (a run of marks and what follows up to the next mark). Each piece of an Arrow
batch is dictionary-encoded by marked word. A task keeps a table of the distinct ones that it has met:
only those that are new to it are segmented, and the ids of all are joined back by position. Nothing
is shuffled. A table that would go over its bound begins anew with the words of the piece at hand, so
that it is no larger than its bound or that piece.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import mapped, pieces, texts_of
from twinview.llm.pieces import MARK, default_model, marked, processor

#: Ids that are decoded at once; one longer list is worked on alone.
PIECE_IDS = 1 << 20
#: Distinct marked words, and bytes of them, that a task keeps in its table.
TABLE_WORDS = 1 << 18
TABLE_BYTES = 16 << 20


def _segmented(words: list[bytes], path: str) -> list[list[int]]:
    """Ids of each marked word; the model puts one mark in front by itself."""
    ids = processor(path).encode([w[1:].decode() if w != b" " else " " for w in words], num_threads=1)
    return [x if w != b" " else _lone_mark(path) for w, x in zip(words, ids)]


def _lone_mark(path: str) -> list[int]:
    """A mark with nothing after it, as at a text's end: what follows "a" in "a "."""
    model = processor(path)
    return model.encode("a ")[len(model.encode("a")):]


class _Table:
    """Marked words with their ids: word i has flat[starts[i]:starts[i] + sizes[i]]."""

    def __init__(self, path: str):
        self.path = path
        self._clear()

    def _clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.held = 0
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The places of distinct words, after those that are new have been segmented."""
        new = [w for w in words if w not in self.places]
        added = sum(map(len, new))
        if len(self.places) + len(new) > TABLE_WORDS or self.held + added > TABLE_BYTES:
            self._clear()
            new, added = words, sum(map(len, words))
        if new:
            ids = _segmented(new, self.path)
            sizes = np.array([len(x) for x in ids], np.int64)
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.held += added
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum()))])
        return np.fromiter((self.places[w] for w in words), np.int64, len(words))


def _encoded(column: pa.Array, path: str, table: _Table | None = None) -> pa.ListArray:
    """The ids of each text, by a table of words that goes on from piece to piece, if one is given."""
    table = table or _Table(path)
    texts = texts_of(column)
    parts = marked([texts.bytes_of(i) for i in range(len(texts))])
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    blank = data == 0x20
    begin = blank.copy()
    begin[1:] &= ~blank[:-1]
    begin[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    starts = np.flatnonzero(begin)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data.tobytes())])
    coded = words.dictionary_encode()
    places = table.find(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    counts = table.sizes[places]
    after = np.concatenate([[0], np.cumsum(counts)])
    where = np.repeat(table.starts[places] - after[:-1], counts) + np.arange(after[-1])
    offsets = after[np.searchsorted(starts, bounds)]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(table.flat[where], pa.int32()))


def _surface(path: str) -> pa.Array:
    model = processor(path)

    def surface(i: int) -> bytes:
        if model.is_control(i):
            return b""
        if model.is_unknown(i):
            return " ⁇ ".encode()
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(MARK, " ").encode()

    return pa.array([surface(i) for i in range(model.get_piece_size())], pa.large_binary())


def _decoded(column: pa.ListArray, table: pa.Array) -> pa.Array:
    if column.null_count:
        column = column.fill_null(pa.scalar([], column.type))
    offsets = column.offsets.to_numpy().astype(np.int64)
    ids = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    strings = table.take(ids)
    at = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2].to_pybytes() if len(strings) else b""
    bounds = at[offsets - offsets[0]] if len(strings) else np.zeros(len(column) + 1, np.int64)
    texts = (data[a:b] for a, b in zip(bounds[:-1], bounds[1:]))
    return pa.array([(t[1:] if t[:1] == b" " else t).decode(errors="replace") for t in texts], pa.string())


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", model: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text, without begin, end or sampling.

    Null and empty texts get an empty list. A text over ``PIECE_BYTES`` is a piece of its own, with arrays
    of many times its size. Rows, repeated or not, and all other columns stay as
    they are; a column that is named like ``ids`` already is replaced. ``model`` is a path that
    every executor has.
    """
    docs = docs.drop(ids)
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Table(path)
        for batch in pieces(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, _encoded(batch.column(text), path, words)], [*batch.schema.names, ids])

    return mapped(docs, run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, ids: str = "ids", text: str = "decoded", model: str | None = None) -> DataFrame:
    """``encoded`` with the text of each list of ids that ``encode`` made; null is an empty list.

    A column that is named like ``text`` already is replaced.
    """
    encoded = encoded.drop(text)
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _surface(path)
        for part in _by_ids(batches, ids):
            yield pa.RecordBatch.from_arrays([*part.columns, _decoded(part.column(ids), table)], [*part.schema.names, text])

    return mapped(encoded, run, T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))


def _by_ids(batches: Iterator[pa.RecordBatch], ids: str) -> Iterator[pa.RecordBatch]:
    """The batches cut to rows of at most ``PIECE_IDS`` ids together, one row at least."""
    for batch in batches:
        ends, first = np.cumsum(batch.column(ids).value_lengths().fill_null(0).to_numpy()), 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + PIECE_IDS, "right")))
            yield batch.slice(first, last - first)
            first = last


def encode_checked(docs: DataFrame, keep: list[str], text: str = "text", model: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``ids``, and ``round_trip``: whether decoding them gives the
    text again (null as the empty text).

    Encoded, decoded and compared piece by piece in one pass, so that neither the text nor what is
    decoded leaves the worker. Rows stay as ``encode`` leaves them.
    """
    path = model or default_model()
    kept = [f for f in docs.schema.fields if f.name in keep and f.name not in ("ids", "round_trip")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, words = _surface(path), _Table(path)
        for batch in pieces(batches, text):
            found = _encoded(batch.column(text), path, words)
            decoded, texts = texts_of(_decoded(found, table)), texts_of(batch.column(text))
            same = [decoded.bytes_of(i) == texts.bytes_of(i) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), found, pa.array(same, pa.bool_())], [*(f.name for f in kept), "ids", "round_trip"])

    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    columns = list(dict.fromkeys([*(f.name for f in kept), text]))
    return mapped(docs.select(*columns), run, T.StructType([*kept, *added]))


def op7_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded: counts and digests of the ids and the decoded text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decode(encode(docs).drop("text"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
