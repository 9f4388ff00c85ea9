"""Operator 12: personal data by a linear-chain conditional random field.

A text is a chain of word shapes: runs of letters by case and length, runs of digits by
length, single signs, each with or without a space before it. The field has weights for the
shapes around a token, for pairs of neighbouring shapes and for pairs of labels. It is
trained by likelihood on a small labelled table and decoded by Viterbi in numpy batches.

The tokens of matches of the base patterns have their labels given before decoding, so one
decoding has both: the base matches and what the field adds, which an exact check of its
kind must pass.
"""

from __future__ import annotations

import hashlib
import ipaddress
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lotwise.llm.common import by_value, table, with_fields

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
#: Tokens to either side whose shapes count, rows of the labelled table that are used at most.
REACH, MAX_ROWS = 4, 5000
#: Characters handled at once, tokens of a block in decoding.
SLICE, STEPS = 1_000_000, 64
#: Weight of a label that is given.
GIVEN = 1e6

# The base patterns. A run of digits is matched whole or not at all, which
# is the same as trying its every place, in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # Without a match the same signs can be looked at again only for the next @, which they do not reach.
        end = domain.end() if domain else at + 1
        if domain:
            yield start, end
        at = text.find("@", end)


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """(start, end) of the base matches of each kind, leftmost first; failing ones are dropped."""
    ips = ((m.start(), m.end()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")))
    cards = ((m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and _luhn(d))
    phones = ((m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15)
    return [list(_emails(text)), list(ips), list(cards), list(phones)]


# Shapes. 0 stands between documents.

_SIGNS = "@.-()[]+_%:/,\"#"
_LETTER, _OTHER_LETTER, _DIGIT, _SIGN = 2, 3, 1, 4
_AT, _DOT, _FOREIGN = 13, 14, 15
_HEX, _FIRST_DIGIT, _FIRST_SIGN = 16, 17, 28
SHAPES = _FIRST_SIGN + len(_SIGNS) + 1


def _classes() -> np.ndarray:
    kinds = np.full(129, _SIGN, np.uint8)
    kinds[[*range(33), 127]] = 0
    kinds[48:58] = _DIGIT
    kinds[65:91] = kinds[97:123] = _LETTER
    kinds[128] = _OTHER_LETTER
    return kinds


def _sign_shapes() -> np.ndarray:
    shapes = np.full(129, _FIRST_SIGN + len(_SIGNS))
    for place, sign in enumerate(_SIGNS):
        shapes[ord(sign)] = _FIRST_SIGN + place
    return shapes


_KIND_OF, _SIGN_SHAPE = _classes(), _sign_shapes()
_DIGIT_ENDS = np.array([1, 2, 3, 4, 5, 7, 11, 15, 19])


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shape (twice, and one more after a space), start and end of each token of a text."""
    code = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128).astype(np.uint8)
    kind = _KIND_OF[code]
    edge = np.ones(len(code) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _SIGN)
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    first, length, sort = code[starts].astype(np.int64), ends - starts, kind[starts]
    upper = np.concatenate([[0], np.cumsum((code >= 65) & (code <= 90))])
    capitals = upper[ends] - upper[starts]
    case = np.where(capitals == 0, 0, np.where(capitals == length, np.where(length > 1, 2, 1), np.where((capitals == 1) & (first <= 90), 1, 3)))
    shape = 1 + 3 * case + np.where(length == 1, 0, np.where(length <= 3, 1, 2))
    lower = np.concatenate([code | 32, np.zeros(3, np.uint8)])
    word = sort == _LETTER
    beyond = np.concatenate([[0], np.cumsum((code | 32) > 102)])
    shape[word & (length <= 4) & (capitals == 0) & (beyond[ends] == beyond[starts])] = _HEX
    shape[word & (length == 2) & (lower[starts] == 97) & (lower[starts + 1] == 116)] = _AT
    shape[word & (length == 3) & (lower[starts] == 100) & (lower[starts + 1] == 111) & (lower[starts + 2] == 116)] = _DOT
    shape[sort == _OTHER_LETTER] = _FOREIGN
    number = sort == _DIGIT
    sizes = _FIRST_DIGIT + np.searchsorted(_DIGIT_ENDS, length)
    # Three digits above 255 have a shape of their own.
    value = (first - 48) * 100 + (lower[starts + 1].astype(np.int64) & 15) * 10 + (lower[starts + 2] & 15)
    sizes[(length == 3) & (value > 255)] = _FIRST_DIGIT + len(_DIGIT_ENDS) + 1
    shape[number] = sizes[number]
    signs = sort == _SIGN
    shape[signs] = _SIGN_SHAPE[first[signs]]
    spaced = np.concatenate([[True], kind == 0])[starts]
    return (2 * shape + spaced).astype(np.int16), starts.astype(np.int32), ends.astype(np.int32)


@dataclass
class Field:
    """A trained field: weights of shapes (place, shape, label), of pairs of neighbouring
    shapes (shape times shapes, label), and of pairs of labels."""

    around: np.ndarray
    pairs: np.ndarray
    steps: np.ndarray

    def scores(self, shapes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Scores (token, label) at places; place 0 is the first after ``REACH`` shapes."""
        found = self.pairs[_pair(shapes[places + REACH], shapes[places + REACH + 1])]
        for ahead in range(2 * REACH + 1):
            found += self.around[ahead][shapes[places + ahead]]
        return found

    def bounds(self) -> tuple[float, float, float]:
        """What the labels of a stretch of personal data can gain over no kind by their steps:
        for each token but the first, for entering and leaving it, and for that if given labels
        may stand beside it."""
        s, plain = self.steps, self.steps[0, 0]
        enter = max(float((s[:, k] - s[:, 0]).max()) for k in range(1, LABELS))
        leave = max(float((s[k] - s[0]).max()) for k in range(1, LABELS))
        return float(s[1:, 1:].max() - plain), float(s[0, 1:].max() + s[1:, 0].max() - 2 * plain), enter + leave


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int32) >> 1) * (2 * SHAPES) + right


# Training.


def examples(rows: int = 600, seed: int = 12) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The labelled table that the field is trained on by default: texts and their spans, made
    by a rule. Half of the texts hold personal data, in and beyond the base patterns; all may
    hold numbers that are none."""
    rnd = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def plain() -> str:
        return "".join(rnd.choice("abcdefghijklmnoprstuvwz") for _ in range(rnd.choice([2, 3, 4, 5, 6, 8, 11])))

    def word() -> str:
        made = plain()
        if rnd.random() < 0.15:
            made = "".join(rnd.choice("éüñçß中ж") if rnd.random() < 0.4 else c for c in made)
        return rnd.choice([made] * 12 + [made.title(), made.upper(), made[0], "A", "at", "the", "dot"][: rnd.randrange(4, 8)])

    def name() -> str:
        return rnd.choice([f"{plain()}.{plain()}", f"{plain()}{number(2)}", f"{plain()}.{number(2)}", f"{plain()}_{plain()}", plain()])

    def host(dot: str) -> str:
        return dot.join([rnd.choice([plain(), f"{plain()}{number(1)}"]), rnd.choice([plain(), "example"]), rnd.choice(["com", "org", "de", "net"])][rnd.randrange(2) :])

    def email() -> str:
        at, dot = rnd.choice([("@", ".")] * 4 + [(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "."), ("@", "[.]")])
        return name() + at + host(dot)

    def octets(dot: str) -> str:
        return dot.join(str(rnd.randrange(256)) for _ in range(4))

    def ip() -> str:
        six = ":".join(f"{rnd.randrange(65536):x}" for _ in range(8))
        return rnd.choice([octets("."), octets("."), octets("[.]"), octets(" dot "), six, re.sub(r":[0-9a-f]+:[0-9a-f]+:", "::", six, count=1)])

    def card() -> str:
        gap = rnd.choice(["", " ", "-", ".", "/"])
        body = number(15)
        body += next(d for d in "0123456789" if _luhn(body + d))
        return gap.join(body[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        return rnd.choice([
            f"+{number(1)} ({number(3)}) 555-{number(4)}", f"+{number(2)} {number(3)} {number(7)}", f"({number(3)}) {number(3)}-{number(4)}",
            f"{number(3)}-{number(3)}-{number(4)}", f"0{number(3)}/{number(7)}", f"0{number(3)} {number(3)} {number(4)}", f"{number(3)}.{number(3)}.{number(4)}",
        ])

    def harmless() -> str:
        return rnd.choice([
            lambda: f"{rnd.randrange(1900, 2100)}", lambda: f"{number(2)}:{number(2)}", lambda: f"{number(1)}.{number(1)}", lambda: f"{number(2)}.{number(3)}",
            lambda: f"v{number(1)}.{number(2)}.{number(1)}", lambda: f"{rnd.randrange(1900, 2100)}-{number(2)}-{number(2)}", lambda: f"${number(3)}.{number(2)}",
            lambda: "token = \"" + "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([16, 32, 40]))) + "\"", lambda: number(rnd.choice([1, 2, 3, 5, 6, 7, 20, 24])),
            lambda: f"({number(1)})", lambda: f"[{number(2)}]", lambda: f"{number(1)},{number(3)},{number(3)}", lambda: f"{number(2)}%", lambda: f"CC BY-NC {number(1)}.0",
            lambda: f"#{number(4)}", lambda: f"{number(2)}/{number(2)}/{number(4)}", lambda: f"@{word()}", lambda: f"{number(3)}-{number(2)}", lambda: f"{word()} at {word()}",
            lambda: f"{word()} dot {word()}", lambda: f"{number(1)}, {number(1)}, {number(1)}", lambda: "| --- | --- |", lambda: f"http://{host('.')}/{word()}",
        ])()

    made = []
    for row in range(rows):
        text, spans = "", []
        for _ in range(rnd.randrange(3, 12)):
            draw, kind = rnd.random(), rnd.randrange(4)
            if row % 2 == 0 and draw < 0.25:
                value = (email, ip, card, phone)[kind]()
                spans.append((KINDS[kind], len(text), len(text) + len(value)))
            else:
                value = harmless() if draw > 0.8 else word()
            text += value + rnd.choice([" "] * 8 + [", ", ". ", "\n", "! ", " - ", "!! ", "; ", " | "])
        made.append((text, spans))
    return made


def _laid_out(rows: list[tuple[str, list]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shapes of all rows, ``REACH`` empty places around each, a row a text; labels; which are tokens."""
    read = [tokens(text) for text, _ in rows]
    width = max((len(r[0]) for r in read), default=0)
    shapes = np.zeros((len(rows), width + 2 * REACH), np.int64)
    labels, real = np.zeros((len(rows), width), np.int64), np.zeros((len(rows), width), bool)
    for i, ((shape, starts, ends), (_, spans)) in enumerate(zip(read, rows)):
        shapes[i, REACH : REACH + len(shape)] = shape
        real[i, : len(shape)] = True
        for kind, start, end in spans:
            labels[i, : len(shape)][(starts >= start) & (ends <= end)] = 1 + KINDS.index(kind)
    return shapes, labels, real


def fit(rows: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 150, ridge: float = 0.02, rate: float = 0.15) -> Field:
    """The field of the largest penalised likelihood of the labelled texts, by gradient steps
    of adapted size. A chain has the label of no kind before and after it."""
    shapes, labels, real = _laid_out(rows)
    n, width = labels.shape
    field = Field(np.zeros((2 * REACH + 1, 2 * SHAPES, LABELS)), np.zeros((SHAPES * 2 * SHAPES, LABELS)), np.zeros((LABELS, LABELS)))
    if not real.any():
        field.around[REACH, :, 0] = 1
        return field
    weights = [field.around, field.pairs, field.steps]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    pair = _pair(shapes[:, REACH : REACH + width], shapes[:, REACH + 1 : REACH + 1 + width])[real]
    windows = [shapes[:, p : p + width][real] for p in range(2 * REACH + 1)]
    hot = np.eye(LABELS)
    wanted = hot[labels] * real[..., None]
    before = np.concatenate([np.zeros((n, 1), np.int64), labels], 1)
    seen = np.zeros((LABELS, LABELS))
    lengths = real.sum(1)
    for t in range(width + 1):
        used = lengths >= t
        after = np.where(t < lengths, labels[:, min(t, width - 1)], 0)
        np.add.at(seen, (before[used, t], after[used]), 1)
    for turn in range(1, rounds + 1):
        score = np.zeros((n, width, LABELS))
        score[real] = field.pairs[pair] + sum(field.around[p][w] for p, w in enumerate(windows))
        # Forward and backward sums of likelihoods, each step scaled to a sum of 1.
        near, step = np.exp(score - score.max(2, keepdims=True)), np.exp(field.steps)
        ahead, back, scale = np.zeros((n, width, LABELS)), np.zeros((n, width, LABELS)), np.ones((n, width))
        for t in range(width):
            now = (step[0] if t == 0 else ahead[:, t - 1] @ step) * near[:, t]
            scale[:, t] = now.sum(1)
            ahead[:, t] = now / scale[:, t, None]
        for t in range(width - 1, -1, -1):
            onward = (near[:, t + 1] * back[:, t + 1] / scale[:, t + 1, None]) @ step.T if t + 1 < width else np.zeros((n, LABELS))
            back[:, t] = np.where((t + 1 == lengths)[:, None], step[:, 0], onward)
        likely = ahead * back
        whole = np.where(real, likely.sum(2), 1.0)[..., None]
        likely = likely / whole * real[..., None]
        weighed = near[:, 1:] * back[:, 1:] / scale[:, 1:, None] / whole[:, 1:] * real[:, 1:, None]
        expected = step * np.einsum("ntj,ntk->jk", ahead[:, :-1], weighed)
        expected[0] += likely[:, 0].sum(0)
        expected[:, 0] += likely[np.arange(n), np.maximum(lengths - 1, 0)].sum(0)
        error = (wanted - likely)[real]
        slopes = [np.stack([_by_code(w, error, 2 * SHAPES) for w in windows]), _by_code(pair, error, len(field.pairs)), seen - expected]
        for w, g, a, b in zip(weights, slopes, first, second):
            g -= ridge * w
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            w += rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.99**turn)) + 1e-8)
    return field


def _by_code(codes: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(codes, values[:, k], size) for k in range(LABELS)], 1)


def fit_on(labelled: DataFrame) -> Field:
    """``fit`` on the first ``MAX_ROWS`` rows of a table of ``text`` and ``spans`` (an array of
    kind, start, end), in the order of the texts."""
    rows = labelled.select("text", "spans").filter("text IS NOT NULL").orderBy("text").limit(MAX_ROWS).collect()
    return fit([(r[0], [(s[0], s[1], s[2]) for s in r[1] or [] if s[0] in KINDS]) for r in rows])


# Decoding.


def best_labels(scores: np.ndarray, steps: np.ndarray, block: int = STEPS) -> np.ndarray:
    """Viterbi over one chain of any length that has no label before and after it. Blocks of
    tokens are decoded side by side, for every label before them; then the blocks' best
    ways are chained, so there are ``block`` steps over all blocks and one step a block."""
    n = len(scores)
    if n == 0:
        return np.zeros(0, np.int64)
    count = -(-n // block)
    padded = np.full((count * block, LABELS), -GIVEN * 4)
    padded[:, 0] = 0
    padded[:n] = scores
    padded = padded.reshape(count, block, LABELS)
    # reached[b, s, k]: the best way through block b so far, from label s before it to label k.
    reached = steps[None] + padded[:, 0, None, :]
    came = np.zeros((count, block, LABELS, LABELS), np.int8)
    for t in range(1, block):
        ways = reached[:, :, :, None] + steps[None, None]
        came[:, t] = ways.argmax(2)
        reached = ways.max(2) + padded[:, t, None, :]
    arrived, choice = np.full(LABELS, -np.inf), np.zeros((count, LABELS), np.int64)
    arrived[0] = 0
    for b in range(count):
        ways = arrived[:, None] + reached[b]
        choice[b] = ways.argmax(0)
        arrived = ways.max(0)
    # Places beyond the end have no label at no cost but that of the steps, which the last token's end has too.
    last, ends = int((arrived + steps[:, 0]).argmax()), np.zeros(count, np.int64)
    starts = np.zeros(count, np.int64)
    for b in range(count - 1, -1, -1):
        ends[b] = last
        starts[b] = last = choice[b, last]
    labels, each, now = np.zeros((count, block), np.int64), np.arange(count), ends
    for t in range(block - 1, -1, -1):
        labels[:, t] = now
        now = came[each, t, starts, now]
    return labels.reshape(-1)[:n]


def decoded(field: Field, shapes: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Labels of the places of many documents. ``shapes`` has ``REACH`` empty places around each
    document; ``given`` has a label, or -1.

    In the best labelling, no stretch of tokens could be better off without labels. What a
    stretch gains is at most the sum of its tokens' best scores over none, and ``bounds``.
    Tokens that no stretch with a gain holds have no label for certain: the chain falls apart
    there, and only what lies between is decoded."""
    n = len(shapes) - 2 * REACH
    labels = np.zeros(max(0, n), np.int8)
    if n <= 0:
        return labels
    inside, ends, beside = field.bounds()
    gain = np.empty(n)
    for at in range(0, n, SLICE):
        scores = field.scores(shapes, np.arange(at, min(n, at + SLICE)))
        gain[at : at + len(scores)] = scores[:, 1:].max(1) - scores[:, 0] + inside
    fixed = given >= 0
    gain[(shapes[REACH : REACH + n] == 0) | fixed] = -GIVEN
    total = np.concatenate([[0.0], np.cumsum(gain)])
    # The best end after, and the best start before, each token; stretches beside given labels.
    after, before = np.maximum.accumulate(total[:0:-1])[::-1], np.minimum.accumulate(total[:-1])
    unsure = after - before + ends - inside > -1e-3
    if fixed.any():
        each = np.arange(n)
        last = np.maximum.accumulate(np.where(fixed, each, -1))
        following = np.minimum.accumulate(np.where(fixed, each, n)[::-1])[::-1]
        unsure |= (last >= 0) & (after - total[last + 1] + beside - inside > -1e-3)
        unsure |= (following < n) & (total[np.minimum(following, n)] - before + beside - inside > -1e-3)
    places = np.flatnonzero(unsure & (gain > -GIVEN) | fixed)
    if len(places) == 0:
        return labels
    scores, own = field.scores(shapes, places), given[places]
    scores[own >= 0] -= GIVEN
    scores[own >= 0, own[own >= 0]] += GIVEN
    # One place of no kind stands for all certain ones between two runs.
    at = np.arange(len(places)) + np.cumsum(np.concatenate([[False], np.diff(places) > 1]))
    chain = np.full((at[-1] + 1, LABELS), -GIVEN)
    chain[:, 0] = 0
    chain[at] = scores
    labels[places] = best_labels(chain, field.steps)[at]
    return labels


# Spans that the field adds.

_OPEN_EMAIL = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_SAID_AT, _SAID_DOT = re.compile(r"\s*[\[(]\s*at\s*[\])]\s*|\s+at\s+", re.I), re.compile(r"\s*[\[(]\s*(?:dot|\.)\s*[\])]\s*|\s+dot\s+", re.I)
_OPEN_PHONE, _OPEN_CARD = re.compile(r"(?:\+|\()?[0-9][0-9 ()./-]*[0-9]"), re.compile(r"[0-9](?:[ ./-]?[0-9])+")


def passes(kind: str, value: str) -> bool:
    """Whether an added span is of the form of its kind."""
    if kind == "email":
        plain = _SAID_AT.sub("@", _SAID_DOT.sub(".", value))
        return _OPEN_EMAIL.fullmatch(plain) is not None
    if kind == "ip":
        try:
            ipaddress.ip_address(_SAID_DOT.sub(".", value))
        except ValueError:
            return False
        return len(value) >= 7
    digits = _digits(value)
    if kind == "card":
        return _OPEN_CARD.fullmatch(value) is not None and 13 <= len(digits) <= 19 and _luhn(digits)
    groups = re.findall("[0-9]+", value)
    return _OPEN_PHONE.fullmatch(value) is not None and 8 <= len(digits) <= 15 and 2 <= len(groups) <= 6 and value.count("(") == value.count(")")


def _pieces(text: str):
    """(offset, piece) of a text, cut before white space into pieces of about ``SLICE`` characters."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE:
            cut = re.compile(r"[\x00-\x20]").search(text, at + SLICE)
            end = cut.start() if cut else end
        yield at, text[at:end]
        at = end


def found(field: Field, texts: list[str]) -> list[tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]]:
    """Per text the base spans and the added spans, each by kind."""
    base, parts, size = [base_spans(t) for t in texts], [], REACH
    for text in texts:
        read = [tuple(x + (at if i else 0) for i, x in enumerate(tokens(piece))) for at, piece in _pieces(text)]
        joined = [np.concatenate([r[i] for r in read]) if read else np.zeros(0, np.int16) for i in range(3)]
        parts.append((size, *joined))
        size += len(joined[0]) + REACH
    shapes, given = np.zeros(size, np.int16), np.full(max(0, size - 2 * REACH), -1, np.int8)
    for (at, shape, starts, ends), spans in zip(parts, base):
        shapes[at : at + len(shape)] = shape
        for kind in range(len(KINDS) - 1, -1, -1):
            for a, b in spans[kind]:
                given[at - REACH + np.searchsorted(ends, a, "right") : at - REACH + np.searchsorted(starts, b)] = 1 + kind
    labels = decoded(field, shapes, given)
    result = []
    for text, spans, (at, shape, starts, ends) in zip(texts, base, parts):
        own, fixed = labels[at - REACH : at - REACH + len(shape)], given[at - REACH : at - REACH + len(shape)]
        added: list[list[tuple[int, int]]] = [[] for _ in KINDS]
        open_ = np.flatnonzero((own > 0) & (fixed < 0))
        if len(open_):
            for run in np.split(open_, np.flatnonzero((np.diff(open_) > 1) | (np.diff(own[open_]) != 0)) + 1):
                a, b = _trimmed(text, int(starts[run[0]]), int(ends[run[-1]]))
                kind = int(own[run[0]]) - 1
                joined = (a > 0 and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum())
                if a < b and not joined and passes(KINDS[kind], text[a:b]):
                    added[kind].append((a, b))
        result.append((spans, added))
    return result


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without the signs that cannot begin or end a span."""
    while a < b and not (text[a].isalnum() or text[a] in "+(_:"):
        a += 1
    while a < b and not (text[b - 1].isalnum() or text[b - 1] in "_:"):
        b -= 1
    return a, b


def _said(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans) for a, b in own)


_FIELDS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def scanned(docs: DataFrame, field: Field) -> DataFrame:
    """Add n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added;
    kind:start:end in code points, by kind, then start) and n_added to all rows; input
    columns of these names are replaced. Null and empty texts have no spans. Texts of any length
    are read whole; repeated rows and null ids give a row each."""
    made = [f.split()[0] for f in _FIELDS.split(", ")]
    docs = docs.drop(*made)
    at = docs.columns.index("text")

    def batches(rows):
        for batch in rows:
            column, first = batch.column(at), 0
            while first < batch.num_rows:
                texts, held = [], 0
                while first + len(texts) < batch.num_rows and (not texts or held < SLICE):
                    texts.append(column[first + len(texts)].as_py() or "")
                    held += len(texts[-1])
                values = []
                for spans, added in found(field, texts):
                    both = [sorted(a + b) for a, b in zip(spans, added)]
                    said = hashlib.sha256(_said(spans).encode()).hexdigest()
                    values.append((*map(len, spans), said, _said(both), sum(map(len, added))))
                part = batch.slice(first, len(texts))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*values), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *made])
                first += len(texts)

    return docs.mapInArrow(batches, with_fields(docs, _FIELDS))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, by a field trained on the default table."""
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), fit(examples())).drop("text")


by_value(__name__)
