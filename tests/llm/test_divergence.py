"""Operator 13 against a plain version and against its SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lotwise.llm import divergence
from tests.llm.conftest import docs_of, odd_texts, words

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, rank int, value string"


def plain_audit(rows, least, top):
    """rows: (lang, source, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = Counter(TERM.findall((text or "").translate(lower)))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    found = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (g, s), c in counts.items() if g == lang}

        def rates(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = Counter()
        for c in own.values():
            whole.update(c)
        p, q = {s: rates(c) for s, c in own.items()}, rates(whole)
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            over = [(q[t] - p[s][t], t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                found |= {(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(listed, 1)}
    return found


def some_rows():
    rnd = random.Random(4)
    vocabulary = words(20, 60).split(" ") + ["Éa", "éa", "Ünd", "中文", "á"]
    rows = []
    for i in range(240):
        lang = rnd.choice(["en", "en", "de", None, ""])
        source = "hot" if rnd.random() < 0.4 else rnd.choice([f"s{n}" for n in range(9)] + [None, ""])
        text = "".join(rnd.choice(vocabulary).title() + rnd.choice([" ", ", ", "\x00", "-7-", "\n", "_"]) for _ in range(rnd.randrange(0, 30)))
        rows.append((lang, source, text))
    rows += [("fr", "s1", None), ("fr", "s2", ""), ("it", "only", "una volta una volta"), rows[3], rows[3]]
    rows += [("en", "s1", t) for _, t in odd_texts()]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i % 50 or None, t, g, s, 1, "term", 2, "v") for i, (g, s, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("bounds", [{}, {"SLICE": 300, "PARTIAL": 20, "CELLS": 40, "BLOCK": 3}])
def test_audit_as_plain_version(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(divergence, name, value)
    rows = some_rows()
    for least, top in ((5, 4), (30, 50)):
        found = divergence.audited(frame(spark, rows), least, top).collect()
        assert len(found) == len(set(found))
        assert {tuple(r) for r in found} == plain_audit(rows, least, top)


def test_empty_and_clashing(spark, odd, none):
    assert divergence.audited(none).collect() == []
    expected = plain_audit([(r.lang, r.source, r.text) for r in odd.collect()], 30, 50)
    assert {tuple(r) for r in divergence.audited(odd).collect()} == expected
    only = docs_of(spark, [(1, None), (2, None)])
    assert divergence.audited(only).collect() == []


def test_long_text_is_one_document():
    import pyarrow as pa

    text = "One two\x00TWO " * 700_000
    made = divergence.counted(*(pa.array([v]) for v in ("en", "s", text))).to_pylist()
    assert sorted((r["term"], r["n"], r["docs"]) for r in made) == [("one", 700_000, 1), ("two", 1_400_000, 1)]


def test_rates_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**12, 3 * 10**12, 7)], "count long, total long, terms long")
    got = row.select(divergence._rate("count", "total", "terms").alias("p")).first().p
    assert got == 1 + 10**9 * (10**12 + 5) // (3 * 10**12 + 35)
