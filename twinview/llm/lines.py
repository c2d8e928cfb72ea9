"""Quality rules: counts of each text, and lines that too many documents of a host share.

The counts of a text need nothing but the text; they are taken for whole Arrow batches at a time.

A line is normalised (A-Z lowered, runs of separators one space, runs of digits one 0) and hashed.
The documents with it are counted per host, and so are the host's. Copies of one text are one
document, and texts without a word none: a text that was copied often is for the near-duplicate
stage, and makes its host's share neither larger nor smaller. Lines
above the limit are removed from the text that ``as_text`` asks for, and a document that keeps too
little is rejected. A line of a third of all documents is summed before the shuffle; back at the
documents it is one join key, which Spark's skew join splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import SPACES, Texts, Words, covered, mapped, mixed, pieces, spans_hashed, texts_of, window_starts, windows_hashed, words_of

# Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
WINDOW = 5  # words

MIN_WORDS = 10
MAX_REPEAT_SHARE = 20  # percent of words in repeated windows
#: A line is removed if more documents of its host have it than both of these allow.
LINE_DOCS = 50
LINE_SHARE = 0.01
#: A document is rejected if a smaller share of its words than this is in lines it keeps.
KEPT_SHARE = 0.3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def _repeated(keys: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur again in their group, and which of them did so before (by position)."""
    own = mixed(keys ^ mixed(groups.astype(np.uint64) + np.uint64(1), 1), 2)
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    again, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order[1:][same]] = True
    again[order[:-1][same]] = True
    return again | before, before


def _lines(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with a word: its first and past-the-last word, and its text."""
    data, bounds = texts.data, texts.bounds
    feeds = np.flatnonzero(data == 0x0A)
    # a word's line: the feeds before it, where a text's end counts as one
    line = np.searchsorted(feeds, words.starts) + np.repeat(np.arange(len(texts)), words.counts)
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(line))[: len(first)]
    return first, last, np.searchsorted(words.bounds, first, "right") - 1


def counts(texts: Texts, words: Words) -> dict[str, np.ndarray]:
    """The counts of each text, by name."""
    data, bounds = texts.data, texts.bounds
    n_words = words.counts
    letters = ~SPACES[data] & (data & 0xC0 != 0x80)
    out = {"n_words": n_words, "word_chars": _per_text(letters, bounds), "n_symbols": _per_text(_SYMBOL[data], bounds)}

    first, last, owner = _lines(texts, words)
    # whole lines, with what stands around their words
    feeds = np.concatenate([[-1], np.flatnonzero(data == 0x0A), [len(data)]])
    begin = np.maximum(feeds[np.searchsorted(feeds, words.starts[first]) - 1] + 1, bounds[owner]) if len(first) else first
    end = np.minimum(feeds[np.searchsorted(feeds, words.ends[last - 1])], bounds[owner + 1]) if len(first) else first
    _, before = _repeated(spans_hashed(data, begin, end), owner)
    out["n_dup_lines"] = np.bincount(owner[before], minlength=len(texts))

    at = window_starts(n_words, words.bounds, WINDOW)
    hashes = windows_hashed(spans_hashed(data, words.starts, words.ends), WINDOW)[at]
    again, _ = _repeated(hashes, np.searchsorted(words.bounds, at, "right") - 1)
    out["n_repeat_words"] = _per_text(covered(at[again], WINDOW, len(words.starts)), words.bounds)
    return out


def normalised_lines(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with a word: the hash of its normal form, its words and its text.

    Hashing the lowered words and then their order makes separators alike; a run of digits counts
    as one 0.
    """
    data = texts.data
    digit = (data >= 0x30) & (data <= 0x39)
    edge = digit.copy()
    edge[1:] &= ~digit[:-1]
    if len(words.starts):
        edge[words.starts] = digit[words.starts]
    keep = ~digit | edge
    lowered = np.where(data - 65 < 26, data + 32, data).astype(np.uint8)
    lowered[digit] = 0x30
    place = np.concatenate([[0], np.cumsum(keep)])
    hashes = spans_hashed(lowered[keep], place[words.starts], place[words.ends], 1)
    first, last, owner = _lines(texts, words)
    with np.errstate(over="ignore"):
        rank = np.arange(len(hashes)) - np.repeat(first, last - first)
        terms = mixed(hashes + mixed(rank.astype(np.uint64), 3), 1)
        sums = np.add.reduceat(terms, first) if len(first) else terms[:0]
    return mixed(sums ^ (last - first).astype(np.uint64), 2), last - first, owner


def without_lines(texts: Texts, gone: pa.ListArray) -> list[str]:
    """Each text without its lines whose hashes are in its list, and without their line feeds."""
    out = []
    words = words_of(texts)
    line, _, owner = normalised_lines(texts, words)
    first, _, _ = _lines(texts, words)
    feeds = np.flatnonzero(texts.data == 0x0A)
    place = np.searchsorted(feeds, words.starts[first]) - np.searchsorted(feeds, texts.bounds[owner])
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        own = slice(bounds[i], bounds[i + 1])
        drop = set(place[own][np.isin(line[own].view(np.int64), gone[i].values.to_numpy())].tolist())
        out.append(b"\n".join(x for n, x in enumerate(texts.bytes_of(i).split(b"\n")) if n not in drop).decode(errors="replace"))
    return out


def _all_lines(docs: DataFrame, text: str) -> DataFrame:
    """One row for each row of ``docs`` and distinct normalised line of it, with its words.

    Columns of ``docs`` but the text, and line (hash), words (in the row's lines of that hash) and
    content (hash of the text).
    """
    others = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = texts_of(batch.column(text))
            line, size, owner = normalised_lines(texts, words_of(texts))
            order = np.lexsort((line, owner))
            line, size, owner = line[order], size[order], owner[order]
            new = np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])]) if len(line) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            if not len(first):
                continue
            content = spans_hashed(texts.data, texts.bounds[:-1], texts.bounds[1:], 3)
            rows = owner[first]
            columns = [batch.column(f.name).take(pa.array(rows)) for f in others]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(line[first].view(np.int64)), pa.array(np.add.reduceat(size, first)), pa.array(content[rows].view(np.int64))],
                [*(f.name for f in others), "line", "words", "content"])

    added = [T.StructField(n, T.LongType()) for n in ("line", "words", "content")]
    return mapped(docs, run, T.StructType([*others, *added]))


def frequent_lines(rows: DataFrame, docs: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """Lines (host, line) that more documents of the host have than ``line_docs`` and than
    ``line_share`` of its documents. On both sides a document is a distinct text with a word."""
    texts = rows.groupBy("host", "line", "content").count()
    found = texts.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > line_docs)
    distinct = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("host", F.xxhash64("text").alias("content")).distinct()
    hosts = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("all_docs"))
    return found.join(hosts, "host").where(F.col("n_docs") > line_share * F.col("all_docs")).select("host", "line", "n_docs")


def quality(docs: DataFrame, host: str = "source", min_words: int = MIN_WORDS, max_repeat_share: int = MAX_REPEAT_SHARE,
            line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, kept_share: float = KEPT_SHARE,
            keep: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc`` (of the columns ``keep``, all by default), with
    its counts and verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; base_failed: fewer than
    ``min_words`` words, or over ``max_repeat_share`` percent of them in repeated windows;
    n_boilerplate: words in lines above the limit; kept: not base_failed, and lines below the limit
    hold ``kept_share`` of all words. With ``as_text`` also cleaned: the text without the lines
    above the limit (``keep`` must have the text then).

    Null and empty texts have no words and fail. A null host is a host. Rows are told apart by
    doc_id: repeated rows share one verdict, and rows of one doc_id with different texts have the
    boilerplate of their own text. A text over ``PIECE_BYTES`` is worked on alone, with arrays of
    many times its size. Other columns stay inside ``doc``. No rows give no rows.
    """
    keep = keep or docs.columns
    fields = [f for f in docs.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = texts_of(batch.column("text"))
            found = counts(texts, words_of(texts))
            content = spans_hashed(texts.data, texts.bounds[:-1], texts.bounds[1:], 3)
            doc = pa.StructArray.from_arrays([batch.column(f.name) for f in fields], [f.name for f in fields])
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [doc, ids, *(pa.array(found[c].astype(np.int64)) for c in _COUNTS), pa.array(content.view(np.int64))],
                ["doc", "doc_id", *_COUNTS, "content"])

    longs = [T.StructField(n, T.LongType()) for n in [*_COUNTS, "content"]]
    counted = mapped(docs, run, T.StructType([T.StructField("doc", T.StructType(fields)), docs.schema["doc_id"], *longs]))

    key = F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit("n")).alias("host")
    lines = _all_lines(docs.select("doc_id", key, "text"), "text")
    limit = frequent_lines(lines, docs.select(key, "text"), line_docs, line_share)
    removed = lines.join(limit, ["host", "line"]).select("doc_id", "content", "line", "words").distinct()
    gone = [F.collect_list("line").alias("gone")] if as_text else []  # no more than the text has lines
    removed = removed.groupBy("doc_id", "content").agg(F.sum("words").alias("n_boilerplate"), *gone)
    removed = removed.withColumnRenamed("content", "_content").withColumnRenamed("doc_id", "_id")
    joined = counted.join(removed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")), "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_share * F.col("n_words"))
    boilerplate = F.coalesce(F.col("n_boilerplate"), F.lit(0)).cast("long")
    left = F.col("n_words") - F.col("n_boilerplate")
    judged = joined.select("doc", *_COUNTS, failed.alias("base_failed"), boilerplate.alias("n_boilerplate"), *(["gone"] if as_text else [])).withColumn(
        "kept", ~F.col("base_failed") & (left >= kept_share * F.col("n_words")))
    return _cleaned(judged) if as_text else judged


def _cleaned(judged: DataFrame) -> DataFrame:
    """``judged`` with cleaned in place of gone, the hashes of the lines to leave out."""
    others = [f for f in judged.schema.fields if f.name != "gone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned: list[str | None] = [None] * batch.num_rows
            rows = np.flatnonzero(batch.column("gone").is_valid().to_numpy(zero_copy_only=False))
            own = pa.RecordBatch.from_arrays(
                [batch.column("doc").field("text").take(pa.array(rows)), batch.column("gone").take(pa.array(rows)), pa.array(rows)], ["text", "gone", "row"])
            for piece in pieces([own], "text"):
                for row, text in zip(piece.column("row").to_pylist(), without_lines(texts_of(piece.column("text")), piece.column("gone"))):
                    cleaned[row] = text
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in others), pa.array(cleaned, pa.string())], [*(f.name for f in others), "cleaned"])

    found = mapped(judged, run, T.StructType([*others, T.StructField("cleaned", T.StringType())]))
    return found.withColumn("cleaned", F.when(F.col("n_boilerplate") > 0, F.col("cleaned")).otherwise(F.col("doc.text")))


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return quality(docs, keep=["doc_id"]).select("doc.doc_id", *_COUNTS, "base_failed", "kept", "n_boilerplate")


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE = f"""
WITH texts AS (SELECT doc_id, source, text, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n
  FROM (SELECT doc_id, i, array_to_string(list_slice(words, i, i + {WINDOW - 1}), ' ') AS w
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM texts WHERE len(words) >= {WINDOW}))),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM windows WHERE n > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, line, {_WORDS.format("line")} AS words
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
normal AS (
  SELECT *, regexp_replace(translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[0-9]+', '0', 'g') AS form
  FROM lines),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM lines GROUP BY source),
frequent AS (
  SELECT coalesce('h' || n.source, 'n') AS host, form
  FROM normal n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source
  GROUP BY n.source, form, docs HAVING count(DISTINCT text) > {LINE_DOCS} AND count(DISTINCT text) > {LINE_SHARE} * docs),
by_line AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dups,
         coalesce(sum(len(words)) FILTER ((coalesce('h' || source, 'n'), form) IN (SELECT (host, form) FROM frequent)), 0) AS boilerplate
  FROM normal GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
         coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, coalesce(boilerplate, 0)::BIGINT AS n_boilerplate
  FROM texts LEFT JOIN by_line USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_SHARE} * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_words - n_boilerplate >= {KEPT_SHARE} * n_words AS kept FROM judged"""
