"""Operator 11 against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>, score long, rank int, vector string"


def plain_negatives(rows, step, k=5, m=10):
    fine = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            fine[i] = min(fine.get(i, (v, label)), (v, label))
    whole = {i: ([math.floor(256 * x) for x in v], label) for i, (v, label) in fine.items()}
    found = set()
    for a, (q, own) in whole.items():
        if a % step:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), i, label) for i, (v, label) in whole.items() if i != a and len(v) == len(q)]
        for ps, p, _ in sorted(s for s in scores if s[2] == own)[:k]:
            fits = sorted(s for s in scores if s[2] != own and 30 * -ps <= 100 * -s[0] <= 90 * -ps)[:m]
            found |= {(a, p, rank, n, -ps, -ns) for rank, (ns, n, _) in enumerate(fits, 1)}
    return found


def some_rows(seed=3, n=500, size=12):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([0, 0, 0, 1, 2, -4]), [rnd.gauss(0, 1) for _ in range(size)]) for i in range(n)]
    rows += [(i, i % 3, rows[40][2]) for i in range(n, n + 60)]
    rows += [
        (1000, None, [1.0] * size), (1020, 0, None), (1040, 0, [1.0, None] + [0.0] * (size - 2)), (1060, 1, [math.nan] * size),
        (1080, 1, [math.inf] * size), (1100, 1, []), (None, 1, [1.0] * size), (1120, 0, [0.0] * size), (1140, 0, [1.0, 2.0]), (1141, 0, [1.5, 2.0]),
        (1142, 1, [0.9, 1.0]), (1160, 2, [5.0] * 70), (1161, 2, [4.0] * 70), (1162, 9, [3.0] * 70), (40, 0, rows[40][2]), (60, 9, rows[60][2]),
        (1180, 7, [1.0] * size), (1200, 1, [1e4] * size), (1201, 1, [9e3] * size),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, y, v, 1, 2, "v") for i, y, v in rows], SCHEMA)


@pytest.mark.parametrize("bounds", [{}, {"WAVE": 7}, {"LEVELS": 1, "PLANES": 2}])
def test_as_plain_version(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(negatives, name, value)
    rows = some_rows()
    # The defaults of functions are bound when these are defined.
    monkeypatch.setattr(negatives.coded, "__defaults__", (negatives.LEVELS,))
    monkeypatch.setattr(negatives.Asked.__init__, "__defaults__", (negatives.LEVELS,))
    found = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == plain_negatives(rows, 20)


def test_nothing_to_find(spark):
    rows = some_rows()
    assert negatives.hard_negatives(frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert negatives.hard_negatives(frame(spark, rows), F.lit(False)).collect() == []
    assert negatives.hard_negatives(frame(spark, rows[:1]), F.lit(True)).collect() == []


def test_large_components(spark):
    """Beyond 64 bits in between but not in the end; then in the end."""
    big = 1e9
    rows = [(0, 1, [big, big, 1.0]), (1, 1, [big, -big, 3.0]), (2, 2, [-big, big, 1.0]), (3, 2, [0.0, 0.0, 2.0]), (4, 1, [1.0, 1.0, 1.0])]
    assert {tuple(r) for r in negatives.hard_negatives(frame(spark, rows), F.col("vec_id") == 0).collect()} == {
        r for r in plain_negatives(rows, 7) if r[0] == 0
    }
    far = [(0, 1, [1e30, 1.0]), (1, 1, [1e30, 2.0]), (2, 2, [6e29, 1.0])]
    with pytest.raises(Exception, match="more than 64 bits"):
        negatives.hard_negatives(frame(spark, far), F.col("vec_id") == 0).collect()


def test_intervals_hold():
    rng = np.random.default_rng(1)
    for size in (1, 3, 64, 130):
        vectors = np.floor(rng.standard_normal((300, size)) * 256)
        vectors[:5] = vectors[7]
        anchors = np.floor(rng.standard_normal((4, size)) * 256)
        anchors[0] = vectors[7]
        block = negatives.Block(np.arange(300), np.zeros(300), vectors, *negatives.coded(vectors))
        asked = negatives.Asked(anchors)
        widths = []
        for a in range(4):
            truth, calls = vectors @ anchors[a], []

            def wanted(low, high, truth=truth, calls=calls):
                assert (low <= truth).all() and (truth <= high).all()
                calls.append((high - low).mean())
                return np.ones(len(low), bool)

            assert len(block.left(asked, a, np.arange(300), wanted)) == 300
            widths.append(calls)
        assert all(w[-1] < 0.5 * w[0] for w in widths if size >= 64)


def test_filter_leaves_few():
    """The intervals rule out nearly all of many vectors before any is scored."""
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.standard_normal((5000, 64)) * 256)
    block = negatives.Block(np.arange(5000), np.zeros(5000), vectors, *negatives.coded(vectors))
    asked, best = negatives.Asked(vectors[:1]), negatives.Best(5)
    left = block.left(asked, 0, np.arange(1, 5000), lambda low, high: high >= negatives._kth(low, 5))
    assert len(left) < 500
    best.offer(block.ids[left], block.scored(left, vectors[0]))
    truth = (vectors[1:] @ vectors[0]).astype(int)
    assert [s for s, _ in best.held] == sorted(truth, reverse=True)[:5]
