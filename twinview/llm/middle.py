"""Fill-in-middle texts by rotating blocks in place.

A text is cut at two units into prefix, middle and suffix. Its bytes go into one bytearray, the
sentinels are inserted at the cuts, and the segments change places by rotations, each of three
reversals inside the array. Restoring finds the sentinels, rotates back and takes them out, so the
text comes back byte by byte. Every text is worked on alone, whatever else is in its batch.

Units are runs of A-Z and a-z, and every other character; they are counted in windows of
``WINDOW`` bytes, and reversed in steps of ``STEP``, so that a very long text (some hundred MB) costs its
Arrow copies and one bytearray, not index arrays of its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twinview.llm.arrow import mapped, pieces, texts_of

# Sentinels, and what they stand before (fixed values).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

SEED = 1
TRANSFORMED = 90  # texts of a hundred
SPM = 20  # of a hundred transformed ones
WINDOW = 1 << 20
STEP = 1 << 16

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_LATER = np.zeros(256, bool)  # bytes of a character after its first
_LATER[0x80:0xC0] = True


def _unit_starts(data: np.ndarray, first: int, last: int) -> np.ndarray:
    """Which bytes of data[first:last] begin a unit."""
    part = data[first:last]
    letter = _LETTER[part]
    inside = _LATER[part]
    inside[1:] |= letter[1:] & letter[:-1]
    if first and len(part):
        inside[0] |= letter[0] & _LETTER[data[first - 1]]
    return ~inside


class Units:
    """The units of one text: how many there are, and at which byte the first ``k`` end."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.edges = [*range(0, len(data), WINDOW), len(data)]
        counts = [int(np.count_nonzero(_unit_starts(data, a, b))) for a, b in zip(self.edges, self.edges[1:])]
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def end(self, k: int) -> int:
        if k >= len(self):
            return len(self.data)
        window = int(np.searchsorted(self.before, k, "right")) - 1  # unit k begins in it
        first = self.edges[window]
        return first + int(np.flatnonzero(_unit_starts(self.data, first, self.edges[window + 1]))[k - self.before[window]])


def characters(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return sum(int(np.count_nonzero(~_LATER[data[i : i + WINDOW]])) for i in range(0, len(data), WINDOW))


def _reverse(view: np.ndarray, first: int, last: int) -> None:
    while last - first > 1:
        n = min(STEP, (last - first) // 2)
        head = view[first : first + n][::-1].copy()
        view[first : first + n] = view[last - n : last][::-1]
        view[last - n : last] = head
        first, last = first + n, last - n


def rotate(buffer: bytearray, first: int, middle: int, last: int) -> None:
    """Exchange buffer[first:middle] and buffer[middle:last] in place, by three reversals."""
    view = np.frombuffer(buffer, np.uint8)  # a view: while it lives the array can't change its length
    _reverse(view, first, middle)
    _reverse(view, middle, last)
    _reverse(view, first, last)


def transform(buffer: bytearray, form: str, prefix: int, middle: int) -> None:
    """Rearrange a text in place: its first ``prefix`` bytes, and those up to byte ``middle``.

    "psm" gives prefix, suffix, middle, "spm" suffix, prefix, middle, each behind its sentinel;
    "plain" changes nothing.
    """
    if form == "plain":
        return
    for at, sentinel in ((middle, SUFFIX), (prefix, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    at_middle, at_suffix = prefix + len(PREFIX), middle + len(PREFIX) + len(MIDDLE)
    rotate(buffer, at_middle, at_suffix, len(buffer))
    if form == "spm":
        rotate(buffer, 0, at_middle, at_middle + len(buffer) - at_suffix)


def restore(buffer: bytearray, form: str) -> None:
    """Undo ``transform`` in place, from the text and its form alone.

    A sentinel neither begins inside another one nor occurs in a rearranged text, so each is found
    once. ValueError if one is missing.
    """
    if form == "plain":
        return
    at_suffix, at_middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
    if form == "spm":
        at_prefix = buffer.index(PREFIX)
        rotate(buffer, at_suffix, at_prefix, at_middle)
        at_suffix = at_middle - at_prefix
    suffix = at_middle - at_suffix
    rotate(buffer, at_suffix, at_middle, len(buffer))
    at_middle, at_suffix = at_suffix, len(buffer) - suffix
    for at in (at_suffix, at_middle, 0):
        del buffer[at : at + len(PREFIX)]


def _draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _planned(doc_id: int | None, data: np.ndarray, whole: bytearray, seed: int, rates: tuple[int, int]) -> tuple[int, str, int, int]:
    """Units, form, and the bytes at which prefix and middle end."""
    units, (h1, h2, h3, h4) = Units(data), _draws(doc_id, seed)
    n = len(units)
    if not n or h3 % 100 >= rates[0] or any(s in whole for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", 0, 0
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, "spm" if h4 % 100 < rates[1] else "psm", units.end(first), units.end(second)


_PLAN = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
         T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]


def fill_in_middle(
    docs: DataFrame, text: str = "text", seed: int = SEED, transformed: int = TRANSFORMED, spm: int = SPM, digests: bool = False
) -> DataFrame:
    """``docs`` with n (units of the text), form, prefix_chars, middle_chars (null if plain), output.

    Cuts and form follow from doc_id and ``seed``: ``transformed`` of a hundred texts are
    rearranged, ``spm`` of a hundred of these with the suffix in front. Texts that are null (as
    empty), empty or hold a sentinel stay plain. A null doc_id draws like a text of its own, the
    same for all of them; rows are worked on one by one, repeated ones alike. Other columns stay, but
    for those named like an output, which are replaced. No rows give no rows.

    With ``digests`` the columns output_sha256 and restored_sha256 stand in place of ``output``, the
    latter of the text that inverting the rotations gives back.
    """
    last = ["output_sha256", "restored_sha256"] if digests else ["output"]
    kept = [f for f in docs.schema.fields if f.name not in {*(f.name for f in _PLAN), *last}]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = texts_of(batch.column(text))
            plans, made = [], []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                data = texts.data[texts.bounds[i] : texts.bounds[i + 1]]
                buffer = bytearray(data)
                n, form, prefix, middle = _planned(doc_id, data, buffer, seed, (transformed, spm))
                chars = (None, None) if form == "plain" else (characters(data[:prefix]), characters(data[prefix:middle]))
                plans.append((n, form, *chars))
                transform(buffer, form, prefix, middle)
                if digests:
                    output = hashlib.sha256(buffer).hexdigest()
                    restore(buffer, form)
                    made.append((output, hashlib.sha256(buffer).hexdigest()))
                else:
                    made.append((buffer.decode(),))
            columns = [pa.array(c, pa.string() if f.dataType == T.StringType() else pa.int64()) for c, f in zip(zip(*plans), _PLAN)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *columns, *(pa.array(c, pa.string()) for c in zip(*made))],
                [*names, *(f.name for f in _PLAN), *last])

    return mapped(docs, run, T.StructType([*kept, *_PLAN, *(T.StructField(c, T.StringType()) for c in last)]))


def restored(rows: DataFrame, output: str = "output", form: str = "form", text: str = "text") -> DataFrame:
    """``rows`` with the column ``text`` that ``output`` was made of; a null output gives the empty
    text, a null form counts as plain. A column named like it is replaced."""
    kept = [f for f in rows.schema.fields if f.name != text or text in (output, form)]
    names = [f.name for f in kept if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, output):
            texts, made = texts_of(batch.column(output)), []
            for i, kind in enumerate(batch.column(form).to_pylist()):
                buffer = bytearray(texts.bytes_of(i))
                restore(buffer, kind or "plain")
                made.append(buffer.decode())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(made, pa.string())], [*names, text])

    return mapped(rows, run, T.StructType([f for f in kept if f.name != text] + [T.StructField(text, T.StringType())]))


def op11_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and rearranged, and restored: digests of both texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fill_in_middle(docs, digests=True).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def _h(i: int) -> str:
    return f"('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), {8 * i + 1}, 8))::BIGINT"


ORACLE = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         {_h(0)} AS h1, {_h(1)} AS h2, {_h(2)} AS h3, {_h(3)} AS h4
  FROM documents),
cuts AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
  FROM texts),
parts AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                      OR h3 % 100 >= {TRANSFORMED} THEN 'plain'
                 WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(list_slice(units, 1, a), '') AS prefix, array_to_string(list_slice(units, a + 1, b), '') AS middle,
         array_to_string(list_slice(units, b + 1, n), '') AS suffix
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
