"""External induced sorting of a text's suffixes with their common prefixes, as far as a depth.

The suffixes that start where characters begin to rise after a fall (LMS) are sorted first: the
substrings between them by tuples, then, where those are equal, the text of their names by
recursion. All others are induced: going through the sorted suffixes, each puts the suffix one
longer into the queue of that one's first character, first those that fall (upwards), then those
that rise (downwards). A queue's entries arrive in order, so a first-in-first-out queue for each
character is a priority queue; its parts go to disk beyond a bound. Entries carry the position,
the characters before it, and the prefix shared with the entry before in the same queue, which is
one more than the least shared prefix since that one's source went by.

Arrays as long as the text are mapped from a scratch file of the task if they are over the bound,
and queues are read in slices, so that the text may be far larger than memory. The scratch file has
no name and goes with the task. Suffixes with a common prefix of ``depth`` or more may stand in any
order, and no longer prefix is told apart: a depth bounds the recursion.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY_BYTES = 192 << 20
EXTENT_BYTES = 64 << 20
SLICE = 1 << 20
#: The recursion goes on while names are few enough for queues, else tuples are doubled.
FEW_NAMES = 64


class Scratch:
    """Arrays in memory up to a bound, beyond it in extents of a nameless file of this task.

    An extent that holds no array any more is used again.
    """

    def __init__(self, memory_bytes: int = MEMORY_BYTES):
        self.left, self.file, self.at, self.spilled = memory_bytes, None, 0, 0
        self.extents: dict[int, np.memmap] = {}  # by first address
        self.used: dict[int, list[int]] = {}  # bytes given and arrays alive
        self.open: int | None = None

    def _extent(self, need: int) -> int:
        for address, (given, alive) in self.used.items():
            if (address == self.open or not alive) and (0 if not alive else given) + need <= len(self.extents[address]):
                if not alive:
                    self.used[address] = [0, 0]
                self.open = address
                return address
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        size = -(-max(need, EXTENT_BYTES) // 4096) * 4096
        self.file.truncate(self.at + size)
        extent = np.memmap(self.file, np.uint8, "r+", self.at, (size,))
        self.at += size
        self.open = extent.ctypes.data
        self.extents[self.open], self.used[self.open] = extent, [0, 0]
        return self.open

    def array(self, size: int, kind: np.dtype | type) -> np.ndarray:
        """An array of zeros."""
        kind = np.dtype(kind)
        need = size * kind.itemsize
        if need <= self.left or not need:
            self.left -= need
            return np.zeros(size, kind)
        room = -(-need // 64) * 64
        address = self._extent(room)
        given = self.used[address][0]
        self.used[address] = [given + room, self.used[address][1] + 1]
        self.spilled += need
        out = self.extents[address][given : given + need].view(np.ndarray).view(kind)
        out[:] = 0
        return out

    def keep(self, values: np.ndarray) -> np.ndarray:
        out = self.array(len(values), values.dtype)
        out[:] = values
        return out

    def free(self, values: np.ndarray) -> None:
        where = values.ctypes.data
        for address, extent in self.extents.items():
            if address <= where < address + len(extent) and len(values):
                self.used[address][1] -= 1
                return
        self.left += values.nbytes


class Queue:
    """First in, first out: entries of several columns, in parts that may be on disk."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.parts = scratch, []

    def put(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.parts.append(tuple(map(self.scratch.keep, columns)))

    def _joined(self, parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        out = parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts)))
        for part in parts:
            for c in part:
                self.scratch.free(c)
        return out

    def take(self) -> Iterator[tuple[np.ndarray, ...]]:
        """The entries so far, then those put meanwhile, some ``SLICE`` at a time."""
        while self.parts:
            count, size = 0, 0
            while count < len(self.parts) and (not count or size + len(self.parts[count][0]) <= SLICE):
                size += len(self.parts[count][0])
                count += 1
            part = self._joined(self.parts[:count])
            del self.parts[:count]
            for first in range(0, size, SLICE):
                yield tuple(c[first : first + SLICE] for c in part)

    def reversed(self) -> Iterator[tuple[np.ndarray, ...]]:
        """All entries, the last first."""
        while self.parts:
            count, size = 0, 0
            while count < len(self.parts) and (not count or size + len(self.parts[-count - 1][0]) <= SLICE):
                count += 1
                size += len(self.parts[-count][0])
            part = self._joined(self.parts[-count:])
            del self.parts[-count:]
            for last in range(size, 0, -SLICE):
                yield tuple(c[max(0, last - SLICE) : last][::-1] for c in part)


def _slices(size: int) -> Iterator[slice]:
    return (slice(a, min(a + SLICE, size)) for a in range(0, size, SLICE))


def rising(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Which suffixes are less than the next one (type S); the last one counts as such."""
    n = len(text)
    out, next_sign, next_rise = scratch.array(n, bool), None, True
    for part in reversed(list(_slices(n))):
        signs = text[part]
        edges = np.flatnonzero(np.append(signs[1:] != signs[:-1], True))  # last of each run
        kind = np.ones(len(edges), bool)
        kind[:-1] = signs[edges[:-1]] < signs[edges[:-1] + 1]
        if next_sign is not None:
            kind[-1] = next_rise if signs[-1] == next_sign else signs[-1] < next_sign
        out[part] = np.repeat(kind, np.diff(edges, prepend=-1))
        next_sign, next_rise = signs[0], bool(kind[0])
    return out


def sorted_ranks(keys: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of the keys and their order; beyond ``SLICE`` by merging sorted runs."""
    if len(keys) <= SLICE:
        order = np.argsort(keys, kind="stable")
        new = keys[order][1:] != keys[order][:-1]
        ranks = np.zeros(len(keys), np.int64)
        ranks[order[1:]] = np.cumsum(new)
        return ranks, order
    runs = []
    for part in _slices(len(keys)):
        order = np.argsort(keys[part], kind="stable")
        runs.append((scratch.keep(keys[part][order]), scratch.keep(order + part.start)))
    sample = np.sort(np.concatenate([k[:: max(1, SLICE // 1024)] for k, _ in runs]))
    cuts = np.unique(sample[:: max(1, 1024 // 2)])[1:]  # ranges of about half a slice
    edges = [np.concatenate([[0], np.searchsorted(k, cuts, "left"), [len(k)]]) for k, _ in runs]
    ranks, order, at, rank = scratch.array(len(keys), np.int64), scratch.array(len(keys), np.int64), 0, 0
    for i in range(len(cuts) + 1):
        parts = [(k[e[i] : e[i + 1]], n[e[i] : e[i + 1]]) for (k, n), e in zip(runs, edges)]
        own, places = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
        if not len(own):
            continue
        by = np.argsort(own, kind="stable")
        own, places = own[by], places[by]
        found = rank + np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
        ranks[places], order[at : at + len(own)] = found, places
        at, rank = at + len(own), int(found[-1]) + 1
    for run in runs:
        for column in run:
            scratch.free(column)
    return ranks, order


def _refined(ranks: np.ndarray, active: np.ndarray, keys: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """``ranks`` of the active ones told apart by their keys as well; those still in a tie.

    A rank is the number of those that are less, so only those in a tie need be sorted again.
    ``active`` holds whole ties.
    """
    own, _ = sorted_ranks(keys, scratch)
    step = int(own.max(initial=0)) + 1
    both = scratch.array(len(active), np.int64)
    for part in _slices(len(active)):
        both[part] = ranks[active[part]].astype(np.int64) * step + own[part]
    scratch.free(own)
    found, order = sorted_ranks(both, scratch)
    # the first of a tie, old and new, in the order of the active ones
    still = scratch.array(len(active), bool)
    old_start = new_start = 0
    last_old = last_new = None
    for part in _slices(len(active)):
        at = order[part]
        olds, news, spots = ranks[active[at]].astype(np.int64), found[at], np.arange(part.start, part.stop)
        fresh_old = np.concatenate([[last_old is None or olds[0] != last_old], olds[1:] != olds[:-1]])
        fresh_new = np.concatenate([[last_new is None or news[0] != last_new], news[1:] != news[:-1]])
        old_first = np.maximum.accumulate(np.where(fresh_old, spots, old_start))
        new_first = np.maximum.accumulate(np.where(fresh_new, spots, new_start))
        both[at] = olds + new_first - old_first
        tied = ~fresh_new
        still[at[tied]] = True
        still[at[np.flatnonzero(tied[1:])]] = True
        if tied[0]:
            still[order[part.start - 1]] = True
        old_start, new_start, last_old, last_new = int(old_first[-1]), int(new_first[-1]), int(olds[-1]), int(news[-1])
    for part in _slices(len(active)):
        ranks[active[part]] = both[part]
    rest = np.concatenate([active[part][still[part]] for part in _slices(len(active))])
    for column in (both, found, order, still):
        scratch.free(column)
    return ranks, rest


def _names(text: np.ndarray, rise: np.ndarray, starts: np.ndarray, depth: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the substrings from one start to the next (itself included), as far as ``depth``,
    and those in a tie.

    A substring is read as characters with their type, some to a key. Of equal beginnings all
    have ended or none, as the type tells an end.
    """
    last = len(text) - 1
    bits = (2 * int(text.max()) + 2).bit_length()
    each, done = max(1, 63 // bits), 0
    ranks, active, ended = scratch.array(len(starts), starts.dtype), np.arange(len(starts), dtype=starts.dtype), []
    while len(active):
        keys, over = scratch.array(len(active), np.int64), scratch.array(len(active), bool)
        for part in _slices(len(active)):
            own = active[part]
            begin = starts[own].astype(np.int64)
            end = np.where(own + 1 < len(starts), starts[np.minimum(own + 1, len(starts) - 1)], last)
            left = np.minimum(end - begin + 1, depth) - done
            key = np.zeros(len(own), np.int64)
            for i in range(each):
                at = np.minimum(begin + done + i, last)
                key = (key << bits) | np.where(left > i, text[at].astype(np.int64) * 2 + rise[at] + 1, 0)
            keys[part], over[part] = key, left <= each
        whole, tied = scratch.array(len(starts), bool), active
        whole[active[over]] = True
        ranks, tied = _refined(ranks, active, keys, scratch)
        ended.append(tied[whole[tied]])
        active = tied[~whole[tied]]
        for column in (keys, over, whole):
            scratch.free(column)
        done += each
    return ranks, np.sort(np.concatenate(ended)) if ended else active


def _doubled(ranks: np.ndarray, active: np.ndarray, starts: np.ndarray, depth: int, scratch: Scratch) -> np.ndarray:
    """Ranks of the suffixes of a text of names, by pairs of ranks twice as far apart; starts: where
    the names stand, so that ties of ``depth`` characters stay."""
    far, n = 1, len(ranks)
    while len(active):
        reach = np.minimum(active.astype(np.int64) + far, n - 1)
        # whole ties: all members have the same characters so far, and reach as far
        active = active[starts[reach].astype(np.int64) - starts[active] < depth]
        if not len(active):
            break
        keys = scratch.array(len(active), np.int64)
        for part in _slices(len(active)):
            behind = active[part].astype(np.int64) + far
            keys[part] = np.where(behind < n, ranks[np.minimum(behind, n - 1)].astype(np.int64) + 1, 0)
        ranks, active = _refined(ranks, active, keys, scratch)
        scratch.free(keys)
        far *= 2
    return ranks


def shared(text: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes up to ``depth``, eight bytes at a time where it is bytes."""
    out = np.full(len(left), depth, np.int64)
    alive, done = np.arange(len(left)), 0
    lanes = np.ndarray((max(len(text) - 7, 0),), "<u8", text, strides=(1,)) if text.dtype == np.uint8 else None
    while len(alive) and done < depth:
        a, b = left[alive] + done, right[alive] + done
        far = np.maximum(a, b)
        if lanes is not None and int(far.max()) < len(lanes):
            apart = lanes[a] ^ lanes[b]
            same = apart == 0
            low = apart[~same] & (~apart[~same] + np.uint64(1))
            out[alive[~same]] = done + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
            done += 8
        else:
            same = (far < len(text)) & (text[np.minimum(a, len(text) - 1)] == text[np.minimum(b, len(text) - 1)])
            out[alive[~same]] = done
            done += 1
        alive = alive[same]
    return np.minimum(out, depth)


class Sorter:
    """Sorts the suffixes of ``text``, which ends with its least character (others may equal it,
    but not the one before)."""

    def __init__(self, text: np.ndarray, depth: int, scratch: Scratch | None = None):
        self.text, self.depth, self.scratch = text, depth, scratch or Scratch()
        self.kind = np.uint8 if depth < 255 else np.int64
        self.index = np.int32 if len(text) < 1 << 31 else np.int64
        signs: set[int] = set()
        for part in _slices(len(text)):
            signs.update(np.unique(text[part]).tolist())
        self.signs = np.array(sorted(signs), np.int64)

    def _bucket(self, signs: np.ndarray) -> np.ndarray:
        found = np.searchsorted(self.signs, signs)
        return found.astype(np.uint8 if len(self.signs) <= 256 else np.int64)

    def _seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted LMS suffixes, and the prefix each shares with the one before."""
        text, scratch = self.text, self.scratch
        rise = rising(text, scratch)
        found = [(np.flatnonzero(rise[part][1:] & ~rise[part][:-1]) + part.start + 1).astype(self.index)
                 for part in (slice(max(p.start - 1, 0), p.stop) for p in _slices(len(text)))]
        starts = scratch.keep(np.concatenate(found))
        sorted_, common = scratch.array(len(starts), self.index), scratch.array(len(starts), self.kind)
        if len(starts):
            ranks, ties = _names(text, rise, starts, self.depth + 1, scratch)
            if len(ties):
                few = len(np.unique(ranks)) * FEW_NAMES < len(ranks)
                ranks = self._recursion(ranks) if few else _doubled(ranks, ties, starts, self.depth, scratch)
            _, order = sorted_ranks(ranks, scratch)
            for part in _slices(len(starts)):
                sorted_[part] = starts[order[part]]
            scratch.free(order)
            scratch.free(ranks)
            for part in _slices(len(starts) - 1):
                common[part.start + 1 : part.stop + 1] = shared(text, sorted_[part], sorted_[part.start + 1 : part.stop + 1], self.depth)
        scratch.free(rise)
        scratch.free(starts)
        return sorted_, common

    def _recursion(self, names: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes of the text of names; a name adds two characters at least."""
        inner, ranks = self.scratch.array(len(names) + 1, np.int64), self.scratch.array(len(names) + 1, np.int64)
        for part in _slices(len(names)):
            inner[part] = names[part].astype(np.int64) + 1
        at = len(inner)
        for positions, _ in Sorter(inner, self.depth // 2 + 2, self.scratch).descending():
            ranks[positions] = at - np.arange(len(positions))
            at -= len(positions)
        return ranks[:-1]

    def _induce(self, queues: list[Queue], since: np.ndarray, positions: np.ndarray, before: np.ndarray,
                common: np.ndarray, take: np.ndarray) -> None:
        """Queue the suffixes one longer than a batch's, where ``take``.

        since[t]: the least prefix shared by what went by since queue t's last source; -1 if it
        had none.
        """
        chosen = np.flatnonzero(take)
        targets = self._bucket(before[chosen])
        order = np.argsort(targets, kind="stable")
        chosen, targets = chosen[order], targets[order]
        first = np.flatnonzero(np.concatenate([[True], targets[1:] != targets[:-1]])) if len(targets) else np.zeros(0, np.int64)
        ends = [*first[1:].tolist(), len(targets)]
        touched = targets[first].astype(np.int64)
        was = since[touched]
        np.minimum(since, int(common.min()), out=since)
        for t, least, a, b in zip(touched.tolist(), was.tolist(), first.tolist(), ends):
            sources = chosen[a:b]
            low = np.minimum.reduceat(common[: sources[-1] + 1], np.concatenate([[0], sources[:-1] + 1])).astype(np.int64) + 1
            low[0] = min(int(low[0]), least + 1)  # 0 if there was no source
            queues[t].put(positions[sources] - 1, np.minimum(low, self.depth).astype(self.kind))
            rest = common[sources[-1] + 1 :]
            since[t] = int(rest.min()) if len(rest) else self.depth

    def _seam(self, left: int, right: int) -> int:
        return int(shared(self.text, np.array([left]), np.array([right]), self.depth)[0])

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches (positions, common) of all suffixes, greatest first; ``common`` is the prefix
        that each shares with the one before it in this order."""
        text, count = self.text, len(self.signs)
        if len(text) < 2:
            yield np.arange(len(text)), np.zeros(len(text), self.kind)
            return
        seeds, seeds_common = self._seeds()
        bounds = np.append(np.searchsorted(_Signs(text, seeds), self.signs), len(seeds)) if len(seeds) else np.zeros(count + 1, np.int64)
        falling = [Queue(self.scratch) for _ in range(count)]
        kept = [Queue(self.scratch) for _ in range(count)]
        since = np.full(count, -1)
        for c, sign in enumerate(self.signs.tolist()):
            tip = -1
            for positions, common in falling[c].take():
                if tip < 0:
                    common = np.concatenate([common[:1] * 0, common[1:]])
                tip = int(positions[-1])
                kept[c].put(positions, common)
                before = text[np.maximum(positions - 1, 0)]
                self._induce(falling, since, positions, before, common, (positions > 0) & (before >= sign))
            for a in range(bounds[c], bounds[c + 1], SLICE):
                b = min(a + SLICE, bounds[c + 1])
                positions, common = seeds[a:b], np.array(seeds_common[a:b])
                if a == bounds[c]:
                    common[0] = self._seam(tip, int(positions[0])) if tip >= 0 else 0
                self._induce(falling, since, positions, text[np.maximum(positions - 1, 0)], common, positions > 0)

        climbing = [Queue(self.scratch) for _ in range(count)]
        since = np.full(count, -1)
        for c in range(count - 1, -1, -1):
            sign, tip = int(self.signs[c]), -1
            if c == 0:  # the last character is the least suffix and comes from no other
                climbing[0].put(np.array([len(text) - 1], self.index), np.zeros(1, self.kind))
            for positions, common in climbing[c].take():
                common = np.array(common)
                if c == 0 and int(positions[-1]) == len(text) - 1 and (len(positions) > 1 or tip >= 0):
                    common[-1] = self._seam(int(positions[-2]) if len(positions) > 1 else tip, len(text) - 1)
                if tip < 0:
                    common[0] = 0
                tip = int(positions[-1])
                yield positions, common
                before = text[np.maximum(positions - 1, 0)]
                self._induce(climbing, since, positions, before, common, (positions > 0) & (before <= sign))
            behind = -1
            for positions, common in kept[c].reversed():
                with_next = 0 if behind < 0 else behind
                if tip >= 0:
                    with_next, tip = self._seam(tip, int(positions[0])), -1
                shifted = np.concatenate([np.array([with_next], self.kind), common[:-1]])
                behind = int(common[-1])
                yield positions, shifted
                before = text[np.maximum(positions - 1, 0)]
                self._induce(climbing, since, positions, before, shifted, (positions > 0) & (before < sign))


class _Signs:
    """First characters of sorted suffixes, for a binary search that reads few of them."""

    def __init__(self, text: np.ndarray, seeds: np.ndarray):
        self.text, self.seeds = text, seeds

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return self.text[self.seeds]
