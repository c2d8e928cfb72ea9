"""Token counts by a finite-state transducer compiled from a BPE model.

The transducer reads characters. A state holds, for each earlier position from which a piece may
still be under way, the node of the pieces' trie reached since, the last piece of the encoding up
to that position, and its token count relative to here: by the locality of BPE the encoding of a
prefix is that of a shorter prefix and one more piece, and a piece may follow another if and only
if the two texts together encode to just these two. Each transition is annotated with the tokens
emitted (the change of the count). States and transitions are compiled when first met.

Characters that no piece has side by side synchronize: whatever the state before them, the state
behind is the same. A text is cut into chunks of equal length, wherever that falls. A chunk's
state map (state before -> tokens, state behind) is therefore constant but for the head up to its
first synchronizing place. All chunks run at once, one character of each in every step; the maps
are then composed in a scan, in which each chunk's head runs from the state behind the chunk
before, until its states are those it had without, and the running sum of the emitted counts
gives every text's tokens.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import mapped, pieces, texts_of
from twinview.llm.pieces import MARK, default_model, marked, ordinary, processor

CHUNK = 256
#: Transitions a worker keeps; beyond it they are compiled anew (only time is lost).
KEPT_TRANSITIONS = 1 << 21

_START = 0
_ROOT = 0
_NONE = -1


class Transducer:
    """States and count-annotated transitions of one model, compiled on demand."""

    def __init__(self, path: str):
        model = processor(path)
        vocabulary = ordinary(model)
        self.names = list(vocabulary)
        self.scores = {p: model.get_score(i) for p, i in vocabulary.items()}
        letters = sorted({c for p in vocabulary for c in p})
        if missing := [c for c in letters if c not in vocabulary]:
            raise ValueError(f"characters without a piece: {missing[:5]}")
        self.classes = np.zeros(0x110000, np.int32)  # 0: in no piece, so in bytes
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.classes[ord(" ")] = self.classes[ord(MARK)]
        self.width = len(letters) + 1
        self.beside = np.zeros((self.width, self.width), bool)
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [_NONE]
        for n, piece in enumerate(self.names):
            codes = [int(self.classes[ord(c)]) for c in piece]
            self.beside[codes[:-1], codes[1:]] = True
            node = _ROOT
            for code in codes:
                if code not in self.children[node]:
                    self.children[node][code] = len(self.children)
                    self.children.append({})
                    self.ends.append(_NONE)
                node = self.children[node][code]
            self.ends[node] = n
        self.follows: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((_ROOT, _NONE, 0),)
        self.states, self.numbers = [start], {start: _START}
        self._resize(1 << 16)

    def _resize(self, size: int) -> None:
        self.size, self.shift, self.filled = size, np.uint64(64 - size.bit_length() + 1), 0
        self.keys = np.full(size, -1, np.int64)
        self.to, self.emit = np.zeros(size, np.int32), np.zeros(size, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is in the table, or where it would be put."""
        with np.errstate(over="ignore"):
            at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        found = self.keys[at]
        wrong = np.flatnonzero((found != keys) & (found != -1))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (self.size - 1)
            found = self.keys[at[wrong]]
            wrong = wrong[(found != keys[wrong]) & (found != -1)]
        return at

    def _segment(self, text: str) -> list[str]:
        """BPE of a short text: the best scored pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, where = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if where < 0:
                return parts
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def _may_follow(self, left: int, right: int) -> bool:
        if (left, right) not in self.follows:
            a, b = (self.names[left] if left != _NONE else ""), self.names[right]
            self.follows[left, right] = self._segment(a + b) == ([a, b] if a else [b])
        return self.follows[left, right]

    def _step(self, state: int, code: int) -> tuple[int, int]:
        """The state behind and the tokens emitted on reading a character of class ``code``."""
        under_way, last, emitted = [], _NONE, None
        for node, before, count in self.states[state]:
            child = self.children[node].get(code)
            if child is None:
                continue
            if emitted is None and self.ends[child] != _NONE and self._may_follow(before, self.ends[child]):
                last, emitted = self.ends[child], count + 1
            if self.children[child]:
                under_way.append((child, before, count))
        if emitted is None:
            raise ValueError("the model's encoding is not local")
        behind = (*((n, b, c - emitted) for n, b, c in under_way), (_ROOT, last, 0))
        if behind not in self.numbers:
            self.numbers[behind] = len(self.states)
            self.states.append(behind)
        return self.numbers[behind], emitted

    def step(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One transition of every lane; classes must not be 0."""
        keys = states * self.width + codes
        at = self._slots(keys)
        if len(new := np.unique(keys[self.keys[at] == -1])):
            while 2 * (self.filled + len(new)) > self.size:
                old = self.keys != -1
                keep = self.keys[old], self.to[old], self.emit[old]
                self._resize(self.size * 4)
                self._insert(*keep)
            steps = [self._step(int(k) // self.width, int(k) % self.width) for k in new]
            self._insert(new, *np.array(steps, np.int32).T)
            at = self._slots(keys)
        return self.to[at].astype(np.int64), self.emit[at]

    def _insert(self, keys: np.ndarray, to: np.ndarray, emit: np.ndarray) -> None:
        left = np.arange(len(keys))
        while len(left):
            at = self._slots(keys[left])
            _, first = np.unique(at, return_index=True)  # of those that meet in a slot one is put
            put = left[first]
            self.keys[at[first]], self.to[at[first]], self.emit[at[first]] = keys[put], to[put], emit[put]
            left = np.delete(left, first)
        self.filled += len(keys)

    def emitted(self, codes: np.ndarray, sync: np.ndarray) -> np.ndarray:
        """Tokens emitted at each character (16 bits; fewer than a piece has characters); ``sync``:
        the state before it doesn't matter."""
        if self.filled > KEPT_TRANSITIONS:
            self._forget()
        total = len(codes)
        lanes = -(-total // CHUNK)
        padded = lanes * CHUNK
        codes = np.concatenate([codes, np.zeros(padded - total, np.int32)]).reshape(lanes, CHUNK)
        sync = np.concatenate([sync, np.ones(padded - total, bool)]).reshape(lanes, CHUNK)
        out = np.zeros((lanes, CHUNK), np.int16)

        # Every chunk as if nothing stood before it: right from its first synchronizing place on.
        behind, trail = np.zeros(lanes, np.int64), np.zeros((lanes, CHUNK), np.int32)
        for i in range(CHUNK):
            behind[sync[:, i]] = _START
            known = np.flatnonzero(codes[:, i])
            behind[known], out[known, i] = self.step(behind[known], codes[known, i])
            if len(known) < lanes:
                behind[codes[:, i] == 0] = _START
            trail[:, i] = behind

        # Compose: the head of each chunk runs from the state behind the chunk before, until it
        # ends or is in a state that it was in before at this place. If that changes the state
        # behind the chunk, the next one runs again. What a chunk without a synchronizing place
        # maps a state to is kept, for others with the same characters.
        heads = np.where(sync.any(1), sync.argmax(1), CHUNK)
        maps: dict[tuple[bytes, int], tuple[np.ndarray, np.ndarray, int]] = {}
        ready = np.flatnonzero(heads > 0)
        while len(ready):
            entry = behind[ready - 1]
            entered = {int(k): (codes[k].tobytes(), int(e)) for k, e in zip(ready, entry) if heads[k] == CHUNK}
            known = [k for k, key in entered.items() if key in maps]
            changed = []
            for k in known:
                out[k], trail[k], exit_ = maps[entered[k]]
                if behind[k] != exit_:
                    behind[k] = exit_
                    changed.append(k + 1)
            found = np.isin(ready, known)
            active, states = ready[~found], entry[~found]
            for i in range(CHUNK):
                more = heads[active] > i
                active, states = active[more], states[more]
                if not len(active):
                    break
                states, out[active, i] = self.step(states, codes[active, i])
                other = trail[active, i] != states
                active, states = active[other], states[other]
                trail[active, i] = states
            if len(active):  # to the end of the chunk, and not as before
                behind[active] = states
                changed += (active + 1).tolist()
            for k in set(entered) - set(known):
                maps[entered[k]] = out[k].copy(), trail[k].copy(), int(trail[k, -1])
            ready = np.array(sorted(k for k in changed if k < lanes and heads[k] > 0), np.int64)
        return out.reshape(-1)[:total]


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def counted(texts: list[bytes], path: str) -> np.ndarray:
    """Tokens of each text."""
    machine = transducer(path)
    whole = b"".join(parts := marked(texts))
    signs = np.frombuffer(whole.decode().encode("utf-32-le"), np.uint32)
    first = np.frombuffer(whole, np.uint8) & 0xC0 != 0x80  # the first byte of each character
    at = np.concatenate([[0], np.cumsum(first)])
    bounds = at[np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)]
    if not len(signs):
        return np.zeros(len(texts), np.int64)
    codes = machine.classes[signs]
    strange = codes == 0
    sync = np.ones(len(codes), bool)
    sync[1:] = strange[1:] | strange[:-1] | ~machine.beside[codes[:-1], codes[1:]]
    sync[bounds[:-1][bounds[:-1] < len(codes)]] = True
    emitted = machine.emitted(codes, sync)
    if strange.any():
        emitted[strange] = np.diff(np.append(np.flatnonzero(first), len(whole)))[strange]  # a token each byte
    sums = np.concatenate([[0], np.cumsum(emitted, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def count_tokens(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of each whole text.

    Null and empty texts have none. Characters that are in no piece count a token for each byte.
    A text over ``PIECE_BYTES`` is worked on alone, with arrays of many times its size.
    Rows and other columns stay as they are; columns of these two names are replaced.
    """
    docs = docs.drop("n_bytes", "n_tokens")
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            whole = texts_of(batch.column(text))
            counts = counted([whole.bytes_of(i) for i in range(len(whole))], path)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.diff(whole.bounds)), pa.array(counts)],
                [*batch.schema.names, "n_bytes", "n_tokens"])

    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return mapped(docs, run, T.StructType([*docs.schema.fields, *added]))


def op1_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
