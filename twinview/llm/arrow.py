"""Texts of Arrow batches as flat NumPy arrays: bytes, documents' bounds, words and their hashes."""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that are worked on at once; one longer text is a piece of its own.
PIECE_BYTES = 4 << 20

# Separators of words (fixed values): space, and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 256


def release() -> None:
    """Give back to the system what was freed: workers stay after a task, and what an idle one holds
    counts against the executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def releasing(function: Callable) -> Callable:
    """A function on groups that releases memory after each."""
    @functools.wraps(function)
    def run(*args):
        try:
            return function(*args)
        finally:
            release()

    run.__signature__ = inspect.signature(function)  # Spark looks at the number of arguments
    return run


def mapped(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` that releases memory at the end of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


@dataclass
class Texts:
    """Bytes of several texts one after the other; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """The UTF-8 bytes of a column of strings or binaries; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(whole[bounds[0] : bounds[-1]], bounds - bounds[0])


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to rows of at most ``limit`` bytes of text together, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        bounds, first = texts_of(batch.column(column)).bounds, 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words by their first and past-the-end byte; text i has words bounds[i] to bounds[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(texts: Texts) -> Words:
    """Maximal runs of bytes other than SPACES; no word crosses the end of a text."""
    data, bounds = texts.data, texts.bounds
    solid = ~SPACES[data]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begin[edges] = solid[edges]
    end[edges - 1] = solid[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(starts, ends, np.searchsorted(starts, bounds))


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    k = _K[seed % 4]
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * k
        values = (values ^ (values >> np.uint64(29))) * _K[(seed + 1) % 4]
    return values ^ (values >> np.uint64(32))


def spans_hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte ranges, equal for equal bytes; eight bytes of all ranges at a time."""
    lengths = (ends - starts).astype(np.int64)
    out = mixed(lengths.astype(np.uint64) + _K[(seed + 2) % 4], seed)
    if not len(lengths):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    short = np.flatnonzero(lengths <= _LONG)
    at, left, lane = starts[short], lengths[short], 0
    while len(short):
        got = lanes[at + 8 * lane] & _MASK[np.minimum(left - 8 * lane, 8)]
        out[short] = mixed(out[short] ^ got, seed + lane)
        lane += 1
        more = left > 8 * lane
        short, at, left = short[more], at[more], left[more]
    for i in np.flatnonzero(lengths > _LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


def windows_hashed(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``width`` consecutive hashes (none if there are fewer), by doubling."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    base = int(_K[(seed + 3) % 4])
    out, have, power, size = None, 0, hashes, 1
    with np.errstate(over="ignore"):
        while size <= width:
            if width & size:
                if out is None:
                    out, have = power, size
                else:  # the part made so far stands before this one
                    n = len(hashes) - (have + size) + 1
                    out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + power[have : have + n]
                    have += size
            if 2 * size <= width:
                n = len(power) - size
                power = power[:n] * np.uint64(pow(base, size, 1 << 64)) + power[size : size + n]
            size *= 2
    return mixed(out, seed)


def window_starts(counts: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Positions of windows that stay inside one text, given each text's items."""
    n = np.maximum(counts - (width - 1), 0)
    total = int(n.sum())
    return np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)


def covered(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which of ``total`` items lie in a window that begins at one of ``starts``."""
    steps = np.zeros(total + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, total), -1)
    return np.cumsum(steps[:-1]) > 0
