"""External induced sorting of suffixes, with common-prefix lengths.

After T. Bingmann, J. Fischer and V. Osipov, "Inducing suffix and LCP arrays in external
memory" (2013): the suffixes that start a rising run after a falling one (S*) are sorted
first; scanning all known suffixes in order then induces those before them. The queues that
carry induced suffixes hold one sequence per character, because within a character suffixes
arrive in their order; blocks beyond a bound of memory lie on disk. A common-prefix value
travels with each suffix: that of two induced neighbours is one more than the least value
between their sources.

Prefixes matter up to ``depth`` characters only, so values are capped there. The reduced
string of S* names is ranked by doubling, which ends at that depth.
"""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

from lotwise.llm.common import by_value

#: Suffixes handled at once, and bytes of queues kept in memory.
BLOCK, MEMORY = 65_536, 64_000_000
_BASE = 0x9E3779B97F4A7C15 | 1


class Hashes:
    """Hash of any substring, from sums over prefixes."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.power = np.cumprod(np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64))
        forward = np.cumprod(np.full(n + 1, _BASE, np.uint64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * forward[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.power[start]


class Queue:
    """First in, first out, of (suffix, common prefix) blocks; on disk beyond a bound."""

    def __init__(self, store: Store):
        self.store, self.blocks = store, deque()

    def push(self, places: np.ndarray, common: np.ndarray) -> None:
        if self.store.used > MEMORY:
            at = self.store.write(places, common)
            self.blocks.append((at, len(places)))
        else:
            self.store.used += places.nbytes + common.nbytes
            self.blocks.append((places, common))

    def pop(self) -> tuple[np.ndarray, np.ndarray]:
        """The blocks at the head, up to about ``BLOCK`` suffixes."""
        taken, size = [], 0
        while self.blocks and size < BLOCK:
            places, common = self.blocks.popleft()
            if isinstance(places, int):
                places, common = self.store.read(places, common)
            else:
                self.store.used -= places.nbytes + common.nbytes
            taken.append((places, common))
            size += len(places)
        return np.concatenate([t[0] for t in taken]), np.concatenate([t[1] for t in taken])


class Store:
    """The file that queues spill to, in the task's own temporary folder."""

    def __init__(self):
        self.used, self.file = 0, None

    def write(self, places: np.ndarray, common: np.ndarray) -> int:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(places.tobytes() + common.tobytes())
        return at

    def read(self, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(at)
        return np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(n), np.uint8)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _kinds(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the one after them (S)."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    # All places up to a change are decided by it; the last character, once only, is one.
    runs = np.diff(differs, prepend=-1)
    small = np.ones(n, bool)
    small[:-1] = np.repeat(text[differs] < text[differs + 1], runs)
    return small


class _Range:
    """Least value in any range of an array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = np.empty(len(first), self.levels[0].dtype)
        level = (np.frexp((last - first + 1).astype(np.float32))[1] - 1).astype(np.uint8)
        order = np.argsort(level, kind="stable")
        ends = np.cumsum(np.bincount(level)).tolist()
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            if a < b:
                own = order[a:b]
                out[own] = np.minimum(self.levels[k][first[own]], self.levels[k][last[own] - (1 << k) + 1])
        return out


class _Induction:
    """One scan: blocks of suffixes in order induce those before them into queues."""

    def __init__(self, text: np.ndarray, small: np.ndarray, want_small: bool, letters: int, depth: int, store: Store):
        self.text, self.small, self.want, self.depth = text, small, want_small, depth
        self.queues = [Queue(store) for _ in range(letters)]
        self.carried = np.full(letters, depth, np.uint8)
        self.begun = np.zeros(letters, bool)

    def scan(self, places: np.ndarray, common: np.ndarray) -> None:
        """``common``: of each suffix and the one scanned before it."""
        before = np.maximum(places - 1, 0)
        induces = np.flatnonzero((places > 0) & (self.small[before] == self.want))
        if not len(induces):
            np.minimum(self.carried, common.min(initial=self.depth), out=self.carried)
            return
        letter = self.text[before[induces]]
        order = np.argsort(letter, kind="stable")
        source, letter = induces[order], letter[order]
        fresh = np.ones(len(letter), bool)
        fresh[1:] = letter[1:] != letter[:-1]
        first = np.where(fresh, 0, np.append(0, source[:-1] + 1))
        value = _Range(common).least(first, source)
        heads = np.flatnonzero(fresh)
        own = letter[heads]
        value[heads] = np.minimum(value[heads], self.carried[own])
        value = np.minimum(value.astype(np.int16) + 1, self.depth).astype(np.uint8)
        value[heads[~self.begun[own]]] = 0
        self.begun[own] = True
        ends = np.append(heads[1:], len(letter))
        for c, a, b in zip(own.tolist(), heads.tolist(), ends.tolist()):
            self.queues[c].push(before[source[a:b]].astype(np.int64), value[a:b])
        # What lies after each letter's last source is carried to its next one.
        rest = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(self.depth))
        np.minimum(self.carried, rest[0], out=self.carried)
        self.carried[own] = rest[source[ends - 1] + 1]


def _induce(text, small, starts, start_common, letters, depth, common_of, emit):
    """Sort all suffixes from the sorted S* suffixes ``starts``. ``emit(places, common)`` gets
    them from the largest to the smallest, each with the value it has in common with the
    suffix emitted before it. ``common_of`` compares two places directly, at the few seams."""
    store = Store()
    rising = _Induction(text, small, False, letters, depth, store)
    bounds = np.searchsorted(text[starts], np.arange(letters + 1))
    large: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(letters)]
    kept = [Queue(store) for _ in range(letters)]
    for c in range(letters):
        last = None
        while rising.queues[c].blocks:
            places, common = rising.queues[c].pop()
            kept[c].push(places, common)
            rising.scan(places, common)
            last = places[-1]
        a, b = bounds[c], bounds[c + 1]
        if a < b:
            seam = start_common[a:b].copy()
            seam[0] = 0 if last is None else common_of(last, starts[a])
            for at in range(0, b - a, BLOCK):
                rising.scan(starts[a + at : min(b, a + at + BLOCK)], seam[at : at + BLOCK])
    falling = _Induction(text, small, True, letters, depth, store)
    # The suffix of the last character has none after it that could induce it.
    final = len(text) - 1
    falling.queues[text[final]].push(np.array([final]), np.array([0], np.uint8))
    falling.begun[text[final]] = True
    for c in range(letters - 1, -1, -1):
        last = None
        while falling.queues[c].blocks:
            places, common = falling.queues[c].pop()
            falling.scan(places, common)
            emit(places, common)
            last = places[-1]
        blocks = []
        while kept[c].blocks:
            blocks.append(kept[c].pop())
        after = None
        for places, common in reversed(blocks):
            # Values stand between a suffix and its smaller neighbour; downwards they shift by one.
            head = (0 if last is None else common_of(last, places[-1])) if after is None else after
            shifted = np.append(np.uint8(head), common[:0:-1]).astype(np.uint8)
            falling.scan(places[::-1], shifted)
            emit(places[::-1], shifted)
            after = common[0]
    store.close()


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` (small non-negative integers, the last one smaller than all
    others and unique) from the largest to the smallest, and the length, at most ``depth``,
    of the prefix that each shares with the one listed before it. Suffixes that share
    ``depth`` characters may stand in any order."""
    letters = int(text.max()) + 1
    small = _kinds(text)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    hashes = Hashes(text)

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Shared prefix lengths by bisection."""
        low, high = np.zeros(len(a), np.int64), np.minimum(depth, len(text) - np.maximum(a, b))
        while (low < high).any():
            half = (low + high + 1) // 2
            same = hashes.of(a, a + half) == hashes.of(b, b + half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low.astype(np.uint8)

    def one(a: int, b: int) -> int:
        return int(common(np.array([a]), np.array([b]))[0])

    if not len(starts):
        order = np.lexsort((np.arange(len(text)),))[::-1]
        order = order[np.argsort(text[order], kind="stable")[::-1]]
        return order, np.append(np.uint8(0), common(order[1:], order[:-1])).astype(np.uint8)
    # First induction: only the order of S* substrings, each up to the next S* place.
    found = []
    rough = starts[np.argsort(text[starts], kind="stable")]
    zero = np.zeros(len(rough), np.uint8)
    is_start = np.zeros(len(text), bool)
    is_start[starts] = True
    _induce(text, small, rough, zero, letters, depth, lambda a, b: 0, lambda p, _: found.append(p[is_start[p]]))
    sorted_starts = np.concatenate(found)[::-1]
    place = np.searchsorted(starts, sorted_starts)
    ends = np.minimum(np.append(starts[1:], len(text) - 1) + 1, len(text))[place]
    same = (np.diff(ends - sorted_starts) == 0) & (np.diff(hashes.of(sorted_starts, ends).view(np.int64)) == 0)
    name = np.zeros(len(starts), np.int64)
    name[place] = np.cumsum(np.append(0, ~same))
    rank = _doubled(name, depth)
    order = np.argsort(rank, kind="stable")
    starts = starts[order]
    between = np.append(np.uint8(0), common(starts[:-1], starts[1:])).astype(np.uint8)
    places, values = [], []
    _induce(text, small, starts, between, letters, depth, one, lambda p, c: (places.append(p), values.append(c)))
    return np.concatenate(places), np.concatenate(values)


def _doubled(name: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of a string of names, each worth two characters or more."""
    rank, width = name, 1
    while width * 2 < depth + 2 and rank.max() + 1 < len(rank):
        after = np.append(rank[width:] + 1, np.zeros(min(width, len(rank)), np.int64))[: len(rank)]
        pair = rank * (len(rank) + 1) + after
        _, rank = np.unique(pair, return_inverse=True)
        width *= 2
    return rank


by_value(__name__)
