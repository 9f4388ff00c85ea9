import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    # Columns that operators use names of.
    " score double, predicted int, a long, b long, spans string, shard int, slot int, row string, key int, node long, rank int"
)
EXTRA = (0.5, 7, 1, 2, "s", 3, 4, "r", 5, 6, 8)


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


def odd_texts():
    """(id, text): nulls, empty and very long texts, copies, near copies and shared passages."""
    base, passage, long_one = words(1, 120), words(2, 60), words(3, 30_000)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "One  TWO"), (6, base), (7, base), (8, " ".join(near)),
        (9, words(4, 40) + " " + passage + " " + words(5, 40)), (10, words(6, 40) + " " + passage + " " + words(7, 40)),
        (11, long_one), (12, long_one + " tail"), (13, "é" * 300), (14, "x" * 500), (15, "żółw 🚗 " * 40), (None, None),
        (None, words(8, 30)), (None, base), (6, base), (16, words(9, 90)), (16, words(10, 90)), (-3, passage),
        (17, "Licensed under the MIT License. " + words(11, 20)), (18, "中文没有空格" * 60), (19, "The trash is trash, stupid moron"),
    ]
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None if i == 4 else "en", "src", None if t is None else len(t), *EXTRA) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return docs_of(spark, odd_texts())


@pytest.fixture(scope="session")
def none(spark):
    return docs_of(spark, [])
