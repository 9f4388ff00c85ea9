"""Operator 12: base spans and decoding against plain versions, accuracy on unseen texts."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import pii
from tests.llm.conftest import docs_of, odd_texts

SF = "/root/testdata/sf0.01"


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(text):
    total = 0
    for i, d in enumerate(digits(text)[::-1]):
        d = d * 2 if i % 2 else d
        total += d // 10 + d % 10
    return total % 10 == 0


PLAIN = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(m)),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
)


def plain_base(text):
    return [[m.span() for m in re.finditer(p, text) if fits(m.group())] for p, fits in PLAIN]


def said(spans):
    return ",".join(f"{k}:{a}:{b}" for k, own in zip(("email", "ip", "card", "phone"), spans) for a, b in own)


@pytest.fixture(scope="module")
def field():
    return pii.fit(pii.examples())


def test_base_spans_as_plain_patterns():
    rnd = random.Random(1)
    pieces = ["@", ".", "a", "b-", "_", "%", "+", "1", "22", "255", "256", "0007", "4111111111111111", "4111 1111-1111 1111", " ", "-", "(", ")", "é", "\n", "..", "a@b.c", "1.2.3.4", "+1 (743) 555-3824"]
    for _ in range(4000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(30)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("a" * 500_000, "1" * 500_000, "a@" * 200_000, "1." * 200_000, "+" * 300_000, "+1 (" * 100_000, "1 " * 200_000, "." * 500_000 + "@"):
        pii.base_spans(text)
    assert time.time() - began < 20


def plain_viterbi(scores, steps):
    best, ways = steps[0] + scores[0], []
    for row in scores[1:]:
        each = best[:, None] + steps
        ways.append(each.argmax(0))
        best = each.max(0) + row
    labels = [int((best + steps[:, 0]).argmax())]
    for back in reversed(ways):
        labels.append(int(back[labels[-1]]))
    return labels[::-1]


@pytest.mark.parametrize("block", [2, 7, 64])
def test_blocks_as_plain_viterbi(block):
    rng = np.random.default_rng(block)
    for n in (1, 2, 5, 63, 64, 65, 300):
        scores, steps = rng.standard_normal((n, pii.LABELS)), rng.standard_normal((pii.LABELS, pii.LABELS))
        assert pii.best_labels(scores, steps, block).tolist() == plain_viterbi(scores, steps)
    assert len(pii.best_labels(np.zeros((0, pii.LABELS)), steps)) == 0


def test_certain_places_change_nothing(field, monkeypatch):
    """The whole chain of each document, by a plain Viterbi, has the same labels."""
    monkeypatch.setattr(pii, "SLICE", 200)
    rnd = random.Random(5)
    for _, texts in enumerate([[t for t, _ in pii.examples(40, 7)], [t or "" for _, t in odd_texts()][:10]]):
        parts = [pii.tokens(t)[0] for t in texts]
        shapes, given = [np.zeros(pii.REACH, np.int16)], []
        for p in parts:
            shapes += [p, np.zeros(pii.REACH, np.int16)]
            given += [rnd.choice([-1] * 30 + [0, 1, 2, 3, 4]) for _ in p] + [-1] * pii.REACH
        shapes, given = np.concatenate(shapes), np.array(given[: len(given) - pii.REACH], np.int8)
        got, at = pii.decoded(field, shapes, given), 0
        for p in parts:
            if len(p):
                scores, own = field.scores(shapes, np.arange(at, at + len(p))), given[at : at + len(p)]
                for t in np.flatnonzero(own >= 0):
                    scores[t] -= pii.GIVEN
                    scores[t, own[t]] += pii.GIVEN
                assert got[at : at + len(p)].tolist() == plain_viterbi(scores, field.steps)
            at += len(p) + pii.REACH


def test_training_climbs():
    """Two rounds more never lower the likelihood of a tiny table, summed over all labellings."""
    import itertools

    rows = [("a 1.2", [("ip", 2, 5)]), ("1 b", []), ("", [])]

    def likelihood(f):
        total = 0.0
        for text, spans in rows[:2]:
            shape, starts, ends = pii.tokens(text)
            padded = np.concatenate([np.zeros(pii.REACH, int), shape, np.zeros(pii.REACH, int)])
            scores = f.scores(padded, np.arange(len(shape)))

            def value(labels, scores=scores):
                chain = [0, *labels, 0]
                return sum(scores[i, k] for i, k in enumerate(labels)) + sum(f.steps[a, b] for a, b in zip(chain, chain[1:]))

            own = [next((1 + pii.KINDS.index(k) for k, a, b in spans if a <= s and e <= b), 0) for s, e in zip(starts, ends)]
            ways = np.array([value(w) for w in itertools.product(range(pii.LABELS), repeat=len(shape))])
            total += value(own) - np.logaddexp.reduce(ways)
        return total

    seen = [likelihood(pii.fit(rows, rounds=n, ridge=0.0, rate=0.02)) for n in (1, 3, 5, 9, 20, 80)]
    assert seen == sorted(seen) and seen[-1] > -0.5
    assert pii.fit([]).steps.shape == (pii.LABELS, pii.LABELS)


def test_unseen_texts(field):
    right = wrong = missed = beyond = 0
    for text, spans in pii.examples(300, 99):
        base, added = pii.found(field, [text])[0]
        got = {(k, a, b) for k, x, y in zip(pii.KINDS, base, added) for a, b in x + y}
        right += len(got & set(spans))
        wrong += len(got - set(spans))
        missed += len(set(spans) - got)
        beyond += sum(map(len, added))
    assert right / (right + wrong) >= 0.97 and right / (right + missed) >= 0.85 and beyond > 50


def test_added_forms(field):
    for text, value in (
        ("please write to jane.doe (at) example (dot) com today", "jane.doe (at) example (dot) com"),
        ("please call (743) 555-3824 today", "(743) 555-3824"),
        ("blocked 10[.]20[.]30[.]40 today", "10[.]20[.]30[.]40"),
    ):
        _, added = pii.found(field, [text])[0]
        assert [text[a:b] for own in added for a, b in own] == [value]
    for text in ("on 2024-05-06 at 12:30 we paid $313.25 for v1.22.3", "meet at the dot", "License, version 2.0", 'token = "9c8b45435718dcc7"', "4094009243589165"):
        assert pii.found(field, [text])[0][1] == [[], [], [], []]


def test_odd_tables(spark, odd, none, field, monkeypatch):
    # Long texts are cut into pieces.
    monkeypatch.setattr(pii, "SLICE", 5000)
    rows = [(50, "x " * 8000 + "a.b@c.de, 4111 1111 1111 1111! 1.2.3.4 +1 (743) 555-3824"), (51, "7" * 20_000), (52, "1 " * 9000), (53, "\x00 a@b.c"), (54, "퟿😀 x@y.zz")]
    docs = docs_of(spark, odd_texts() + rows)
    found = pii.scanned(docs, field).collect()
    assert len(found) == len(odd_texts()) + len(rows)
    for r in found:
        base = plain_base(r.text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == list(map(len, base))
        assert r.base_sha256 == hashlib.sha256(said(base).encode()).hexdigest()
        assert set(said(base).split(",")) - {""} <= set(r.spans.split(","))
        assert r.score == 0.5 and r.rank == 8
    assert pii.scanned(none, field).collect() == []


def test_whole_table(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = pii.op12_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, base))
        assert r.base_sha256 == hashlib.sha256(said(base).encode()).hexdigest()
        order = [(pii.KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in r.spans.split(",") if s)]
        assert order == sorted(order) and len(order) == sum(map(len, base)) + r.n_added


def test_labelled_table(spark):
    rows = [(t, [{"kind": k, "start": a, "end": b} for k, a, b in s], 1) for t, s in pii.examples(60)] + [(None, None, 1), ("", None, 2)]
    table = spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:int,end:int>>, score int")
    docs = spark.createDataFrame([(1, "mail ab.12@example.org now")], "doc_id long, text string")
    got = pii.scanned(docs, pii.fit_on(table.withColumn("extra", F.lit(1)))).first()
    assert got.n_email == 1 and got.spans == "email:5:22"
