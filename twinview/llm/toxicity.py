"""Toxicity: noisy-channel restoration of words, then a score of the restored text.

The language model is the counts of three characters in a row over all documents (words lowered,
each between two bounds); its table is bounded by the alphabet. A token is noisy if it has signs
that stand for letters between letters, separators between single letters, or a letter three times
in a row; so is a row of single letters set apart by spaces. A noisy token is a lattice: each
character may be what it is, a letter it is written for, or nothing (separators, repeats). The
best path under the channel's costs and the language model is found by Viterbi decoding. Other
tokens have one path only and are left as they are. In a row, and in a token with several gaps of
separators, a gap may also be a bound of words, and each word of the path counts. No length is
too long: the work is linear in it.

Features are a restored word and its first letters. Their weights are log odds of the contexts
in which they stand in toxic and in other labelled texts; a word's contexts are the words before,
those of first letters the words they begin. So copies of a text, which have the same contexts,
lend a word no support, and first letters count only if many words with them are toxic. Labels are learnt from
training rows only, and from at most ``sample_rows`` of them; the rows taken depend on ids alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import LOWER, Texts, Words, mapped, pieces, spans_hashed, texts_of, words_of

# What a sign may be written for (fixed values).
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
        "|": "il", "+": "t", "(": "c", "€": "e", "¡": "i", "*": "aeiou", "#": "h"}
SEPARATORS = ".-_*~'`,:;/\\ "

SAME, WRITTEN, LEFT_OUT = math.log(0.85), math.log(0.1), math.log(0.05)

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))) + "0123456789"
_BOUND = len(ALPHABET)
_OTHER = _BOUND + 1
_SIZE = _OTHER + 1
_CODES = np.full(0x110000, _OTHER, np.int64)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_CODES[range(ord("A"), ord("Z") + 1)] = np.arange(26)
_CODES[[c for c in range(0xC0, 0xDF) if c != 0xD7]] = _CODES[[c + 32 for c in range(0xC0, 0xDF) if c != 0xD7]]
_CODES[[0x20, *range(0x09, 0x0E)]] = _BOUND

#: At most about so many training rows of label 1 are learnt from, and twice as many others.
TRAIN_ROWS = 3_000
MIN_CONTEXTS = 3
#: The evidence for a feature, less the log of the features tested, in nats.
MIN_EVIDENCE = 3.0
MIN_ODDS = 3.5
FEATURES = 20_000
SAMPLE_SEED = 11
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
#: The log probability that a word of a row is a certain one of those known, at least.
KNOWN = math.log(1e-4)

_LETTER = r"[^\W\d_]"
_SIGNS = re.escape("".join(LEET))
_NOISY = re.compile(
    rf"{_LETTER}[{_SIGNS}]+{_LETTER}|^[{_SIGNS}]+{_LETTER}{{2}}|{_LETTER}{{2}}[0-9$@!|]+$"
    rf"|({_LETTER})\1\1|(?:^|\W){_LETTER}(?:[{re.escape(SEPARATORS)}]+{_LETTER}){{2}}", re.I)
# What may stand before and after a word; for the end, of the text turned round, as a search would be quadratic.
_HEAD = re.compile(r"[^\w@$!|+(€¡*#]*")
_TAIL = re.compile(r"[^\w@$!|+€*#]*")
_JUNK = re.compile(r"(?:[^\w]|_)*")
_THRICE = re.compile(r"(.)\1\1", re.I)
_PLAIN_EDGES = ".,;:?\"'()[]{}&%"
_GAPS = re.compile(" +|[^ ]")
_BLANKS = re.compile(r"[\x09-\x0d\x20]+")
_PARTS = re.compile(rf"[^{re.escape(''.join(c for c in SEPARATORS if c not in LEET and c != chr(39)))}]+")
_SPACED = 4  # single letters in a row that may be words


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(code, n) of three characters in a row, over whole texts; code is in base ``_SIZE``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, np.int64)
        for batch in pieces(batches, text):
            texts = texts_of(batch.column(text))
            signs = np.frombuffer(b" ".join(texts.bytes_of(i) for i in range(len(texts))).decode().encode("utf-32-le"), np.uint32)
            codes = np.concatenate([[_BOUND, _BOUND], _CODES[signs], [_BOUND]])
            total += np.bincount(codes[:-2] * _SIZE**2 + codes[1:-1] * _SIZE + codes[2:], minlength=_SIZE**3)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    return mapped(docs.select(text), run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Channel:
    """Restores noisy tokens under a character language model."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        three = np.zeros(_SIZE**3)
        three[codes] = counts
        three = three.reshape(_SIZE, _SIZE, _SIZE)
        two, one = three.sum(0), three.sum((0, 1))
        p1 = (one + 1) / (one.sum() + _SIZE)
        p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
        p3 = (three + 5 * p2[None]) / (three.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)

    def restore(self, token: str) -> str:
        """The likeliest text for a token in lower case; a gap of spaces in it is a bound of words or nothing."""
        # a path is (path before, letter), so equal beginnings are kept once
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(_BOUND, _BOUND): (0.0, None)}
        signs = _GAPS.findall(token)
        narrow = min((len(sign) for sign in signs if sign[0] == " "), default=0)
        before = ""
        for sign in [*signs, None]:
            grown: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            if sign is None:
                options = [("", _BOUND, 0.0)]
            elif sign[0] == " ":
                options = [(" ", _BOUND, 0.0), ("", -1, LEFT_OUT * (len(sign) - narrow))]
            else:
                options = [(sign, int(_CODES[ord(sign)]), SAME)]
                options += [(c, int(_CODES[ord(c)]), WRITTEN - math.log(len(LEET[sign]))) for c in LEET.get(sign, "")]
                if sign in SEPARATORS or sign == before:
                    options.append(("", -1, LEFT_OUT if sign in SEPARATORS else SAME))
                before = sign
            for (a, b), (cost, path) in paths.items():
                for letter, code, price in options:
                    state, value = ((a, b), cost + price) if code < 0 else ((b, code), cost + price + float(self.log[a, b, code]))
                    if state not in grown or value > grown[state][0]:
                        grown[state] = (value, (path, letter) if letter else path)
            paths = grown
        path, letters = max(paths.values(), key=lambda p: p[0])[1], []
        while path:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters))

    def row_words(self, row: str, known: Collection[str] = ()) -> list[str]:
        """Words of a row in lower case, whose gaps are bounds of words or nothing.

        Those of the likeliest path; those of ``known`` in its letters where a path through them is
        likelier if a known word has the probability ``KNOWN``; and the row as one word, as the first
        or the last sign may be a word of its own.
        """
        path = self.restore(row).split()
        whole = _without_end(self.restore(row.replace(" ", "")), _JUNK)
        found = Counter(_without_end(w, _JUNK) for w in path)
        # the path may leave out one of two equal letters, as written they are there
        for letters in {"".join(path), row.replace(" ", "")}:
            found |= Counter(self._known_words(letters, known))
        found |= Counter({whole, whole[1:], whole[:-1]})
        return [w for w in found.elements() if w]

    def _known_words(self, letters: str, known: Collection[str]) -> list[str]:
        """The known words on the likeliest path through letters, with a bound of words anywhere."""
        sizes = sorted({len(w) for w in known if 2 < len(w) <= len(letters)})
        if not sizes:
            return []
        codes = [int(_CODES[ord(c)]) for c in letters]
        # by the place after a bound: the letter before the bound, the path's value and its known words
        at: list[tuple[int, float, tuple | None] | None] = [None] * (len(letters) + 1)
        at[0] = (_BOUND, 0.0, None)
        open_words: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for i in range(len(letters) + 1):
            ended = [(a, value + float(self.log[a0, a, _BOUND]), path) for (a0, a), (value, path) in open_words.items()]
            best = max([*([at[i]] if at[i] else []), *ended], key=lambda x: x[1])
            at[i] = best
            if i == len(letters):
                break
            for n in sizes:
                if i + n <= len(letters) and (word := letters[i : i + n]) in known:
                    jump = (codes[i + n - 1], best[1] + KNOWN, (best[2], word))
                    if at[i + n] is None or jump[1] > at[i + n][1]:
                        at[i + n] = jump
            grown: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (value, path) in [((best[0], _BOUND), best[1:]), *open_words.items()]:
                state, value = (b, codes[i]), value + float(self.log[a, b, codes[i]])
                if state not in grown or value > grown[state][0]:
                    grown[state] = (value, path)
            open_words = grown
        path, words = at[-1][2], []
        while path:
            path, word = path
            words.append(word)
        return words


def _without_end(token: str, end: re.Pattern) -> str:
    return token[: len(token) - end.match(token[::-1]).end()]


def _token_words(token: str, channel: Channel | None) -> str:
    """A token's word: lowered, without what stands around it, restored if it is noisy."""
    plain = token.strip(_PLAIN_EDGES)
    if plain.isalpha() and not _THRICE.search(plain):
        return plain.lower()
    token = token.lower()
    bare = _without_end(token[_HEAD.match(token).end() :], _TAIL)
    if channel and _NOISY.search(bare):
        plain = _without_end(bare, _JUNK)
        if plain != bare and not _NOISY.search(plain):
            return plain
        return _without_end(channel.restore(bare), _JUNK)
    return _without_end(bare, _JUNK)


def _features(word: str) -> list[str]:
    """The word, without a plural's end, and its first letters (with a star)."""
    if len(word) <= 2:
        return []
    return [word, *([word[:-1]] if word[-1] == "s" and len(word) > 4 else []), *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def _restored(texts: Texts, words: Words, channel: Channel, known: Collection[str] = ()) -> tuple[list[str], np.ndarray, list[tuple[int, int, str]]]:
    """Distinct restored tokens, each word's token, and (text, word, restored) of the words in rows.

    A row is of single characters set apart by spaces, or one token with several gaps of separators.
    """
    lowered = LOWER[texts.data]
    hashes = spans_hashed(lowered, words.starts, words.ends)
    _, first, code = np.unique(hashes, return_index=True, return_inverse=True)
    code = code.reshape(-1)
    flat = lowered.tobytes()
    owner = np.repeat(np.arange(len(texts)), words.counts)
    tokens, spaced = [], []
    for c, (a, b) in enumerate(zip(words.starts[first].tolist(), words.ends[first].tolist())):
        token = flat[a:b].decode(errors="replace")
        tokens.append(_token_words(token, channel))
        parts = _PARTS.findall(token.lower())
        if len(parts) >= _SPACED and len(set(parts)) > 2:
            more = Counter(channel.row_words(" ".join(parts), known)) - Counter([tokens[c]])
            spaced += [(int(owner[i]), i, w) for i in np.flatnonzero(code == c).tolist() for w in more.elements()]
    # rows of single characters
    size = np.diff(np.concatenate([[0], np.cumsum(lowered & 0xC0 != 0x80)])[np.stack([words.starts, words.ends])], axis=0)[0] if len(words.starts) else np.zeros(0)
    single = size == 1
    edge = np.flatnonzero(np.concatenate([[True], (single[1:] != single[:-1]) | (owner[1:] != owner[:-1]), [True]])) if len(single) else np.zeros(1, int)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if single[a] and b - a >= _SPACED:
            row = flat[words.starts[a] : words.ends[b - 1]].decode(errors="replace").lower()
            if len(set(row.split())) > 2:
                row = _BLANKS.sub(lambda m: " " * len(m[0]), row)
                spaced += [(int(owner[a]), a, w) for w in channel.row_words(row, known)]
    return tokens, code, spaced


def crc_part(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; null as of the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4


def context_counts(labelled: DataFrame, channel: Channel, text: str = "text", label: str = "toxic") -> DataFrame:
    """(feature, toxic, other): distinct contexts of a feature in texts of label 1 and of others.

    Of each text a feature's first context counts, so there are no more contexts than texts.
    """
    shared = labelled.sparkSession.sparkContext.broadcast(channel)  # bounded by the alphabet

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = texts_of(batch.column(text))
            words = words_of(texts)
            tokens, code, spaced = _restored(texts, words, shared.value)
            features = [_features(t) for t in tokens]
            crc = [zlib.crc32(t.encode()) for t in tokens]
            rows, more = [], defaultdict(list)
            for t, _, word in spaced:
                more[t].append(word)
            for i, value in enumerate(batch.column(label).to_pylist()):
                own = code[words.bounds[i] : words.bounds[i + 1]].tolist()
                first: dict[str, int] = {}
                for before, c in zip([-1, *own], own):
                    for f in features[c]:
                        first.setdefault(f, crc[c] if f[-1] == "*" else crc[before] if before >= 0 else 0)
                for word in more[i]:
                    for f in _features(word):
                        first.setdefault(f, 1)
                rows += [(f, c, value == 1) for f, c in first.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["feature", "context", "is_toxic"])

    found = mapped(labelled.select(text, label), run, "feature string, context long, is_toxic boolean")
    found = found.groupBy("feature", "context", "is_toxic").count()
    return found.groupBy("feature").agg(F.count_if(F.col("is_toxic")).alias("toxic"), F.count_if(~F.col("is_toxic")).alias("other"))


def learn(docs: DataFrame, labels: DataFrame, channel: Channel, sample_rows: int = TRAIN_ROWS) -> tuple[dict[str, float], float]:
    """Weights of at most ``FEATURES`` features, and the bias, from training rows.

    A feature is taken if its share of toxic contexts is higher than chance by a margin that grows
    with the number of features tested.
    """
    known = labels.where(F.col("toxic").isNotNull() & (crc_part(F.col("doc_id")) != 2)).select(
        "doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")).distinct()
    all_toxic, everything = known.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    all_other = everything - all_toxic
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SAMPLE_SEED)), F.lit(1 << 20)) / (1 << 20)
    share = F.when(F.col("toxic") == 1, sample_rows / max(all_toxic, 1)).otherwise(2 * sample_rows / max(all_other, 1))
    # ids and labels of some 3 * sample_rows rows: so many are sent to the texts, which stay where they are
    rows = docs.select("doc_id", "text").join(F.broadcast(known.where(draw < share)), "doc_id")
    n_toxic, n_other = min(all_toxic, sample_rows), min(all_other, 2 * sample_rows)
    base = (n_toxic + 1) / (n_toxic + n_other + 2)
    t, o = F.col("toxic"), F.col("other")
    rate = t / (t + o)
    evidence = t * F.log(rate / base) + F.when(o > 0, o * F.log((1 - rate) / (1 - base))).otherwise(0)
    odds = F.log((t + 0.1) / (n_toxic + 1.0)) - F.log((o + 0.1) / (n_other + 1.0))
    best = context_counts(rows, channel).where(t >= MIN_CONTEXTS).withColumn("odds", odds).withColumn("evidence", evidence)
    best = best.where((F.col("odds") >= MIN_ODDS) & (rate > base)).orderBy(F.desc("evidence"), "feature").limit(FEATURES).collect()
    # as many features are tested as have the contexts to be taken at all
    least = MIN_EVIDENCE + math.log(max(len(best), 1))
    bias = math.log((all_toxic + 1.0) / (all_other + 1.0)) - 2.0
    return {r["feature"]: r["odds"] for r in best if r["evidence"] >= least}, bias


def score(docs: DataFrame, channel: Channel, weights: dict[str, float], bias: float, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that label 1 fits the restored text.

    The strongest feature of each token counts; a text's strongest token counts whole and the others
    a tenth. Null and empty texts, and those without a known feature, get the bias alone. A text over
    ``PIECE_BYTES`` is worked on alone, and read to its end. Rows and other columns stay; a column of the score's name is replaced.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast((channel, weights))  # bounded: FEATURES, alphabet

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel, weights = shared.value
        known = {f for f in weights if f[-1] != "*"}
        for batch in pieces(batches, text):
            texts = texts_of(batch.column(text))
            words = words_of(texts)
            tokens, code, spaced = _restored(texts, words, channel, known)
            worth = np.array([max((weights.get(f, 0.0) for f in _features(t)), default=0.0) for t in tokens] or [0.0])
            each = worth[code] if len(code) else np.zeros(0)
            most, total = np.zeros(len(texts)), np.zeros(len(texts))
            owner = np.repeat(np.arange(len(texts)), words.counts)
            hit = np.flatnonzero(each)
            np.maximum.at(most, owner[hit], each[hit])
            np.add.at(total, owner[hit], each[hit])
            for t, _, word in spaced:
                value = max((weights.get(f, 0.0) for f in _features(word)), default=0.0)
                most[t], total[t] = max(most[t], value), total[t] + value
            logit = bias + most + 0.1 * (total - most)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-logit)))], [*batch.schema.names, name])

    return mapped(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def fit_channel(docs: DataFrame, text: str = "text") -> Channel:
    """The channel with the language model of all of ``docs``."""
    table = character_counts(docs, text).toPandas()  # bounded by the alphabet
    return Channel(table["code"].to_numpy(np.int64), table["n"].to_numpy(np.int64))


def op8_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    channel = fit_channel(docs)
    weights, bias = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), channel)
    return score(docs, channel, weights, bias).select(
        "doc_id", (crc_part(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
