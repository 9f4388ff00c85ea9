"""Byte-level BPE as a tree reduction: halves are encoded by themselves and joined.

A text longer than a leaf is cut in the middle, wherever that is. What is known of a part
alone is a ``Part``: ids that stand whatever stands beside it, and the rims before and after
them, which its neighbours may change. Two neighbours are joined by the window of the rims
that meet: it reaches from the cut to the next place on either side that no match of the split
pattern reaches over (white space after other text; the pattern looks at no character before
its match), so the ids outside are proven, and the window is encoded anew. A part without
such a place is a rim as a whole, and the window grows with the next join. Joins are
associative, and the empty part changes nothing.

A match is encoded the same way, by bytes: halves by themselves, joined by a window that grows
by tokens until the outermost token of the window and its outer neighbour encode, as a pair,
to themselves. A sequence of tokens is the BPE of its bytes if each pair of neighbours is, so
the joined sequence is proven. A short match is laid out by the same rule: the longest token
at a place that its left neighbour is stable with, and a shorter one where no token fits
after it. What two tokens encode to is found by merging, once for each pair.

Decoding concatenates the tokens' bytes up the same tree.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lotwise.llm.common import by_value, per_worker

# The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
LEAF = 512
#: Bytes of a match that is laid out as it is.
SHORT_MATCH = 16
#: Segments kept per worker process (about 120 MB), and as many matches.
CACHE = 600_000
#: Pairs of tokens kept (about 50 MB).
PAIRS = 400_000

_REPEATED = re.compile(f"[{WHITE}] ")
_SEGMENT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_LAST_GAP = re.compile(f"(?s).*[^{WHITE}](?=[{WHITE}])")
_WHITE = re.compile(f"[{WHITE}]")
_GAP = re.compile(f"[^{WHITE}](?=[{WHITE}])")


@dataclass(frozen=True)
class Part:
    """What is known of a stretch of text: ``middle``, ids that are proven, as bytes, and the
    text before and after. ``middle`` is none where the text has no place that all matches
    keep to; it is ``left`` then."""

    left: str = ""
    middle: bytes | None = None
    right: str = ""


def joined(written: pa.Array, ids: np.ndarray) -> bytes:
    """What is written for the ids, one after the other."""
    found = written.take(pa.array(ids))
    if found.null_count:
        raise KeyError("an id that the vocabulary does not have")
    _, ends, data = found.buffers()
    if data is None:
        return b""
    start, stop = np.frombuffer(ends, np.int32)[[found.offset, found.offset + len(found)]].tolist()
    return data.slice(start, stop - start).to_pybytes()


class TreeEncoder(dict):
    """Encoder for one vocabulary of ranks. As a dict it maps what follows a space up to the
    next space to that segment's ids as little-endian unsigned 32-bit bytes. With ``library``,
    short segments are encoded by a library of the same vocabulary, which is faster. Strings
    of ``special`` are found in any text first, the longest at a place, and have ids of their own."""

    def __init__(
        self, ranks_path: str, pattern: str, leaf: int = LEAF, short_match: int = SHORT_MATCH, library: bool = False,
        special: dict[str, int] | None = None, cache: int = CACHE,
    ):
        import regex

        with open(ranks_path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.vocabulary = {rank: token for token, rank in self.ranks.items()}
        self.special = special or {}
        self.vocabulary |= {rank: token.encode() for token, rank in self.special.items()}
        known = [self.vocabulary.get(i) for i in range(max(self.vocabulary) + 1)]
        #: What each id stands for, and its decimal digits with a comma after them.
        self.written_bytes = pa.array(known, pa.binary())
        self.written_ids = pa.array([f"{i}," if token is not None else None for i, token in enumerate(known)], pa.binary())
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(pattern)
        self.leaf, self.short_match, self.cache = max(2, leaf), max(2, short_match), cache
        self.base = None
        if library:
            import tiktoken

            self.base = tiktoken.Encoding("leaf", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.pairs: dict[tuple[int, int], bool] = {}
        #: The most bytes of a token, by its first four bytes; those without a key have three at most.
        self.longest: dict[bytes, int] = {}
        for token in self.ranks:
            self.longest[token[:4]] = max(len(token), self.longest.get(token[:4], 3))
        self.size = {rank: len(token) for token, rank in self.ranks.items()}
        #: By token, the longest other one that it begins with.
        self.shorter: dict[int, int] = {}
        for token, rank in self.ranks.items():
            known = next((r for n in range(len(token) - 1, 0, -1) if (r := self.ranks.get(token[:n])) is not None), None)
            if known is not None:
                self.shorter[rank] = known
        #: Ids of matches: a word is one whatever stands beside it in its segment.
        self.matches: dict[str, bytes] = {}
        #: Joins of neighbours so far: of parts, and of halves of a match.
        self.joins, self.halves = 0, 0

    @staticmethod
    def of(
        ranks_path: str, pattern: str, library: bool = False, special: tuple[tuple[str, int], ...] = (), cache: int = CACHE
    ) -> TreeEncoder:
        """The worker process's encoder."""
        key = ("bpe", ranks_path, pattern, library, special, cache)
        return per_worker(key, lambda: TreeEncoder(ranks_path, pattern, library=library, special=dict(special), cache=cache))

    def __missing__(self, after_space: str) -> bytes:
        ids = self._segment(" " + after_space)
        if len(self) < self.cache and len(after_space) < 64:
            self[after_space] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text of any length, as little-endian unsigned 32-bit integers."""
        if self.cut is None:
            return self.whole(self.part(text, 0, len(text)))
        # Every second one is a special string.
        found = self.cut.split(text)
        return b"".join(
            np.array([self.special[t]], "<u4").tobytes() if i % 2 else self.whole(self.part(t, 0, len(t))) for i, t in enumerate(found)
        )

    def whole(self, part: Part) -> bytes:
        """Ids of a part that nothing stands beside."""
        return self._ids(part.left) + (part.middle or b"") + self._ids(part.right)

    def part(self, text: str, low: int, high: int) -> Part:
        """What is known of ``text[low:high]`` alone: of halves, joined."""
        if high - low > self.leaf:
            half = (low + high) // 2
            return self.join(self.part(text, low, half), self.part(text, half, high))
        own = text[low:high]
        first = _GAP.search(own)
        if first is None:
            return Part(own)
        last = _LAST_GAP.match(own).end()
        return Part(own[: first.end()], self._ids(own[first.end() : last]), own[last:])

    def join(self, a: Part, b: Part) -> Part:
        """What is known of two neighbours together; the text of ``b`` follows that of ``a``."""
        if a == Part() or b == Part():
            return b if a == Part() else a
        self.joins += 1
        before = a.left if a.middle is None else a.right
        if a.middle is not None and b.middle is not None:
            return Part(a.left, a.middle + self._ids(before + b.left) + b.middle, b.right)
        # The cut itself may be a place that no match reaches over.
        if before and b.left and not _WHITE.match(before[-1]) and _WHITE.match(b.left):
            left, middle = (before, b"") if a.middle is None else (a.left, a.middle + self._ids(before))
            return Part(left, middle, b.left) if b.middle is None else Part(left, middle + self._ids(b.left) + b.middle, b.right)
        if a.middle is None:
            return Part(before + b.left, b.middle, b.right)
        return Part(a.left, a.middle, before + b.left)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; halves are decoded by themselves and concatenated."""
        # A part has a fixed cost here, so that leaves are larger.
        if len(ids) <= 16 * self.leaf:
            return joined(self.written_bytes, ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def _ids(self, text: str) -> bytes:
        """Ids of a text by its segments, each up to the next space."""
        if not _REPEATED.search(text):
            first, *others = text.split(" ")
            return self._segment(first) + b"".join(map(self.__getitem__, others))
        parts = _SEGMENT.findall(text)
        return b"".join(self[p[1:]] if p[0] == " " else self._segment(p) for p in parts)

    def _segment(self, segment: str) -> bytes:
        if not segment:
            return b""
        if self.base is not None and len(segment) < 64:
            return np.array(self.base.encode_ordinary(segment), "<u4").tobytes()
        found = self.pattern.findall(segment)
        return self._match(found[0]) if len(found) == 1 else b"".join(map(self._match, found))

    def _match(self, match: str) -> bytes:
        known = self.matches.get(match)
        if known is None:
            ids = self._piece(match.encode())
            known = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.matches) < self.cache and len(match) < 64:
                self.matches[match] = known
        return known

    def _piece(self, data: bytes) -> list[int]:
        """One match: halves by themselves, joined by windows of tokens."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) <= self.short_match:
            return self._laid(data)
        self.halves += 1
        half = len(data) // 2
        left, right = self._piece(data[:half]), self._piece(data[half:])
        if self._stable(left[-1], right[0]):
            return left + right
        k = 2
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            middle = self._merge(b"".join(self.vocabulary[i] for i in left[a:] + right[:b]))
            if (a == 0 or self._stable(left[a - 1], middle[0])) and (b == len(right) or self._stable(middle[-1], right[b])):
                return left[:a] + middle + right[b:]
            k *= 2

    def _laid(self, data: bytes) -> list[int]:
        """Tokens from left to right, each the longest that is stable beside the one before. A
        place that none can follow is never come to again: the tokens up to a place, each pair
        stable, are its only ones, so every place is tried once."""
        rank_of, pairs, longest, shorter, size = self.ranks.get, self.pairs, self.longest, self.shorter, self.size
        ids, dead = [], set()
        at, last, n = 0, None, len(data)
        while at < n:
            stop = at + longest.get(data[at : at + 4], 3)
            if stop > n:
                stop = n
            token = rank_of(data[at:stop])
            while token is None:
                stop -= 1
                token = rank_of(data[at:stop])
            while token is not None:
                if not dead or at + size[token] not in dead:
                    if last is None:
                        break
                    known = pairs.get((last, token))
                    if known or (known is None and self._stable(last, token)):
                        break
                token = shorter.get(token)
            if token is not None:
                ids.append(token)
                at += size[token]
                last = token
            else:
                dead.add(at)
                at -= size[ids.pop()]
                last = ids[-1] if ids else None
        return ids

    def _stable(self, a: int, b: int) -> bool:
        """Whether the tokens, side by side, encode to themselves."""
        if (a, b) not in self.pairs:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = self._merge(self.vocabulary[a] + self.vocabulary[b]) == [a, b]
        return self.pairs[a, b]

    def _merge(self, data: bytes) -> list[int]:
        """The definition: merge the leftmost pair of the lowest rank until none is left."""
        if len(data) > 64:
            return self._merge_long(data)
        rank_of, none = self.ranks.get, len(self.ranks) + 1
        parts = [data[i : i + 1] for i in range(len(data))]
        found = [rank_of(a + b, none) for a, b in zip(parts, parts[1:])]
        while found:
            least = min(found)
            if least == none:
                break
            at = found.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            # Only the pairs beside the merged one are new.
            if at < len(found):
                found[at] = rank_of(parts[at] + parts[at + 1], none)
            if at:
                found[at - 1] = rank_of(parts[at - 1] + parts[at], none)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs, for windows that grow over much repetition."""
        n, ranks = len(data), self.ranks
        stop, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, end = heapq.heappop(heap)
            middle = stop[at]
            # Pairs whose tokens have been merged with others meanwhile are left over.
            if middle <= at or middle >= n or stop[middle] != end:
                continue
            stop[at], stop[middle] = end, 0
            if end < n:
                before[end] = at
                if (r := ranks.get(data[at : stop[end]])) is not None:
                    heapq.heappush(heap, (r, at, stop[end]))
            if at and (r := ranks.get(data[before[at] : end])) is not None:
                heapq.heappush(heap, (r, before[at], end))
        found, at = [], 0
        while at < n:
            found.append(ranks[data[at : stop[at]]])
            at = stop[at]
        return found


by_value(__name__)
