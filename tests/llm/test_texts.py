"""Operators on whole texts against plain versions of them."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm import bpe, licenses, ngram_join, packing, suffix_dedup
from lotwise.llm.induced import suffix_order
from lotwise.llm.tokens import TreeEncoder
from tests.llm.conftest import docs_of, odd_texts, words

tiktoken = pytest.importorskip("tiktoken")


def reference(name):
    with open(bpe.vocabulary_path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=bpe.split_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def multi():
    return reference("byte_bpe_multi_50k.tiktoken")


# Operator 9


def test_tree_encoding_is_that_of_the_library(multi):
    pieces = ["ab", " ", "\n", "'", "s", "'ll", "  ", "1", "é", "中", "🙂", "the", "\x1c", "　", "!", "aa", "\r\n", "ſ", "٣"]
    rnd = random.Random(1)
    for leaf, short_match in ((2, 2), (7, 8), (16, 33), (64, 256)):
        tree = TreeEncoder(bpe.vocabulary_path(), bpe.split_pattern(), leaf, short_match)
        for _ in range(400):
            text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 120)))
            if rnd.random() < 0.3:
                text = re.sub(r"\s", "", text)
            ids = np.frombuffer(tree.encode(text), "<u4")
            assert ids.tolist() == multi.encode_ordinary(text), repr(text)
            assert tree.decode(ids) == text.encode()


def test_stable_neighbours_are_the_merged_ones():
    """Tokens laid out by stable pairs against the definition, without the split pattern."""
    tree, rnd = TreeEncoder(bpe.vocabulary_path(), bpe.split_pattern()), random.Random(3)
    for _ in range(4000):
        n = rnd.randint(1, 24)
        data = bytes(rnd.choices(rnd.choice((b"aehinorst ", b" aAeE\n-", bytes(range(256)))), k=n))
        assert tree._laid(data) == tree._merge(data), data


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 9_000 + "  " * 5_000, "中文" * 6_000, " " * 20_000 + "x", "!?" * 8_000])
def test_long_runs_without_a_gap(multi, text):
    tree = TreeEncoder(bpe.vocabulary_path(), bpe.split_pattern())
    assert np.frombuffer(tree.encode(text), "<u4").tolist() == multi.encode_ordinary(text)


def test_parts_are_joined_in_most_documents(spark, multi):
    """By the tree with its own merges: no library encodes anything here."""
    tree = TreeEncoder(bpe.vocabulary_path(), bpe.split_pattern())
    assert tree.base is None
    joined, texts = 0, [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for text in texts:
        before = tree.joins
        assert np.frombuffer(tree.encode(text), "<u4").tolist() == multi.encode_ordinary(text)
        joined += tree.joins > before
    assert joined > 0.5 * len(texts) and tree.halves > 0


def test_joins_are_associative():
    rnd = random.Random(3)
    tree = TreeEncoder(bpe.vocabulary_path(), bpe.split_pattern(), leaf=5, short_match=4)
    for _ in range(300):
        text = "".join(rnd.choice(["ab", "the", " ", "\n", "é", "'ll", "1", "  ", "word"]) for _ in range(rnd.randint(0, 40)))
        cuts = sorted(rnd.randint(0, len(text)) for _ in range(rnd.randint(0, 6)))
        pieces = [tree.part(text, a, b) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        while len(pieces) > 1:
            i = rnd.randrange(len(pieces) - 1)
            pieces[i : i + 2] = [tree.join(pieces[i], pieces[i + 1])]
        assert tree.whole(pieces[0]) == tree.encode(text)


def test_token_digests(spark, odd, none, multi):
    rows = bpe.digests(odd.select("doc_id", "text")).collect()
    expected = Counter()
    for i, text in odd_texts():
        ids = multi.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        expected[i, len(ids), *sha] += 1
    assert Counter(map(tuple, rows)) == expected
    assert bpe.digests(none.select("doc_id", "text")).collect() == []
    encoded = bpe.encode(odd)
    assert set(odd.columns) < set(encoded.columns)
    for row in encoded.select("text", "ids", "decoded").collect():
        assert row.ids == multi.encode_ordinary(row.text or "") and row.decoded == (row.text or "").encode()


# Operator 5


def test_ids_are_those_of_the_tokenizers_file():
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    special = dict(packing.added_tokens(bpe.vocabulary_path("byte_bpe_50k.json")))
    assert special == {"<|endoftext|>": 50256}
    tree = TreeEncoder(bpe.vocabulary_path("byte_bpe_50k.tiktoken"), bpe.split_pattern(), library=True, special=special)
    mixed = ["<|endoftext|> a", "a  <|endoftext|>", "one <|endoftext|><|endoftext|> two", "<|endoftext|", "  <|endoftext|>  x\n\n<|endoftext|>", "word<|endoftext|>word " * 300]
    for text in [t or "" for _, t in odd_texts()] + mixed + ["\x00\x01", "don't  stop\n\n\n"]:
        assert np.frombuffer(tree.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_an_encoder_keeps_no_more_segments_than_it_may():
    paths = bpe.vocabulary_path("byte_bpe_50k.tiktoken"), bpe.split_pattern()
    few, many = TreeEncoder(*paths, library=True, cache=2), TreeEncoder(*paths, library=True)
    for text in [words(i, 50) for i in range(5)]:
        assert few.encode(text) == many.encode(text)
    assert len(few) == 2 < len(many)


def test_texts_of_a_large_batch_are_taken_in_parts(spark, odd, monkeypatch):
    """What a task makes of 1,300 texts in one batch comes in slices: it never holds them all."""
    tasks, kind = [], type(odd)
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *args: tasks.append(f) or real(self, f, *args))
    texts = [words(i, 5) for i in range(1300)]
    packing.tokenized(odd)
    made = list(tasks[-1](iter([pa.record_batch([pa.array(range(1300)), pa.array(texts)], ["_key", "_text"])])))
    assert [b.num_rows for b in made] == [512, 512, 276]
    assert [k for b in made for k in b.column(0).to_pylist()] == list(range(1300))
    suffix_dedup.deduplicated(odd.select("doc_id", "text"))
    spans = pa.array([[(0, 1)]] + [None] * 1299, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
    made = list(tasks[-1](iter([pa.record_batch([pa.array(texts), spans, pa.array(range(1300))], ["text", "spans", "doc_id"])])))
    assert [b.num_rows for b in made] == [512, 512, 276]
    assert [t for b in made for t in b.column(0).to_pylist()] == [texts[0][1:], *texts[1:]]


def check_packing(rows, expected, capacity):
    """Pieces are the expected ones and lie gapless in sequences."""
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, odd, none):
    plain = reference("byte_bpe_50k.tiktoken")
    expected = Counter()
    for i, text in odd_texts():
        ids = plain.encode_ordinary(text or "") + [2]
        for piece, (start, length) in enumerate(packing.pieces_of(len(ids), 1024)):
            expected[i, piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    rows = packing.packed_documents(odd).collect()
    used = check_packing(rows, expected, 1024)
    total = sum(r.length for r in rows)
    assert -(-total // 1024) <= used <= -(-total // 1024) + 1
    assert packing.packed_documents(none).collect() == []
    full = packing.tokenized(odd.filter("doc_id = 11")).orderBy("piece").collect()
    assert [t for r in full for t in r.ids] == plain.encode_ordinary(words(3, 30_000)) + [2]
    assert {r.length for r in full[1:]} == {1024}


def test_added_tokens_are_packed(spark):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    rows = [(1, "<|endoftext|> a"), (2, "b <|endoftext|>"), (3, "c<|endoftext|>d " * 700), (3, "c<|endoftext|>d " * 700), (3, "other"), (None, "x"), (None, "x")]
    expected = Counter()
    for i, text in rows:
        ids = plain.encode(text, add_special_tokens=False).ids + [2]
        for piece, (start, length) in enumerate(packing.pieces_of(len(ids), 1024)):
            expected[i, piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    check_packing(packing.packed_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), expected, 1024)


def best_fit(lengths, capacity):
    """Plain best fit, longest first: the number of sequences."""
    room = []
    for length in sorted(lengths, reverse=True):
        fit = min((r for r in room if r >= length), default=None)
        if fit is None:
            room.append(capacity - length)
        else:
            room[room.index(fit)] = fit - length
    return len(room)


def test_plan_is_best_fit():
    rnd = random.Random(5)
    for _ in range(200):
        capacity = rnd.choice([7, 16, 100])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 300))]
        slots = packing.plan(Counter(lengths), capacity)
        filled = defaultdict(set)
        ranks = defaultdict(set)
        for length, first, count, sequence, offset in slots:
            for i in range(count):
                place = set(range(offset, offset + length))
                assert not filled[sequence + i] & place and offset + length <= capacity
                filled[sequence + i] |= place
                assert first + i not in ranks[length]
                ranks[length].add(first + i)
        assert {k: len(v) for k, v in ranks.items()} == Counter(lengths)
        assert all(p == set(range(len(p))) for p in filled.values())
        assert len(filled) == best_fit(lengths, capacity)


def test_packed_keeps_other_columns(spark):
    pieces = spark.createDataFrame([(i, 3, "x", i, i) for i in range(10)], "id int, length int, row string, rank int, offset int")
    rows = packing.packed(pieces, ["id"], 9).collect()
    assert sorted((r.id, r["row"], r["rank"]) for r in rows) == [(i, "x", i) for i in range(10)]
    assert len({r.sequence_id for r in rows}) == 4


# Operator 1


def plain_words(text):
    lower = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    return re.findall(licenses.WORD, lower)


def test_license_phrases_have_all_their_places(spark, odd, none):
    mit, notice = "under the MIT license", licenses.NOTICES["bsd"]
    cut = notice.split()
    extra = [
        (30, f"{mit}; {mit}, Apache License, Version 2. cc-by-nc"), (31, "under the mit ſ license"), (32, "cc by"), (33, "CC BY NC"),
        (34, "x " + " ".join([*cut[:8], "really", *cut[8:]]) + " y"), (35, " ".join(cut[:6])), (36, "under the mit license " * 3000),
        (37, "éunder the mit license"), (38, "apache\x00license\x7fversion\x2f2"), (39, "apache licenses version 2"), (39, mit),
    ]
    rows = licenses.scanned(odd.unionByName(docs_of(spark, extra))).collect()
    expected = Counter()
    for i, text in odd_texts() + extra:
        found = plain_words(text)
        places = defaultdict(list)
        for phrase, label in licenses.PHRASES.items():
            size = len(phrase.split())
            places[label] += [p for p in range(len(found)) if found[p : p + size] == phrase.split()]
        spots = sorted(p for ps in places.values() for p in ps)
        base = ",".join(sorted(k for k, v in places.items() if v))
        expected[i, len(found), len(spots), spots[0] if spots else None, spots[-1] if spots else None, base] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == expected
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[30].labels, by_id[30].score) == ("apache-2,cc-by-nc,mit", 1.0)
    assert by_id[34].labels == "bsd" and by_id[34].base_labels == "" and 0.75 <= by_id[34].score < 1
    assert by_id[35].labels == "" and by_id[35].score == 0
    assert licenses.scanned(none).collect() == []


def test_fragments_around_a_notice(spark):
    """Fragments of a notice, however many, neither hide the whole one nor make one."""
    mit, gpl = licenses.NOTICES["mit"], licenses.NOTICES["gpl"]
    rnd = random.Random(6)

    def fragments(text, n):
        tokens = text.split(" ")
        cuts = [rnd.randrange(len(tokens) - 4) for _ in range(n)]
        return " ".join(" ".join(tokens[c : c + 4]) for c in cuts)

    rows = [
        (1, "Permission is hereby granted " * 60 + mit), (2, mit), (3, "Permission is hereby granted " * 60), (4, mit + " charge to any person" * 90),
        (5, fragments(mit, 40) + " " + mit + " " + fragments(mit, 40)), (6, fragments(gpl, 30) + " filler " * 50 + gpl), (7, " word ".join(mit.split(" ")[:20])),
    ] + [(10 + i, fragments(mit, 12) + " " + " ".join(t for t in mit.split(" ") if rnd.random() < 0.97)) for i in range(12)]

    def plain(text):
        """The best window of twice the words over the votes of neighbouring diagonals."""
        lower = str.maketrans(licenses.UPPER, licenses.LOWER)
        own = re.findall(licenses.WORD, text.translate(lower))
        score, labels = 0.0, set()
        for label, notice in licenses.NOTICES.items():
            known = re.findall(licenses.WORD, notice.translate(lower))
            grams = [tuple(known[i : i + 3]) for i in range(len(known) - 2)]
            votes = [(p - q, p, q) for p in range(len(own) - 2) for q, g in enumerate(grams) if tuple(own[p : p + 3]) == g]
            spans, last = [], None
            for d, p, q in sorted(votes):
                if last is None or d - last > licenses.NEAR:
                    spans.append([])
                spans[-1].append((p, q))
                last = d
            for span in spans:
                best = max(len({q for p, q in span if a <= p <= a + 2 * len(known) - 3}) for a, _ in span) / len(grams)
                if best >= licenses.COVERED:
                    labels.add(label)
                    score = max(score, best)
        return ",".join(sorted(labels)), score

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(docs).collect()}
    assert found == {i: plain(t) for i, t in rows}
    assert found[1] == found[2] == ("mit", 1.0) and found[3] == ("", 0.0) and found[5] == ("mit", 1.0)


def test_license_templates_too_many_for_a_broadcast(spark, odd, monkeypatch):
    usual = Counter(map(tuple, licenses.scanned(odd).collect()))
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)
    assert Counter(map(tuple, licenses.scanned(odd).collect())) == usual


# Operator 6


def plain_components(rows):
    """Size and smallest reachable id of every row, by comparing all pairs."""
    sets = []
    for _, text in rows:
        parts = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        width = min(5, len(parts))
        sets.append({tuple(parts[p : p + width]) for p in range(len(parts) - width + 1)} if parts else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                parent[find(x)] = find(y)
    groups = defaultdict(list)
    for x in range(len(rows)):
        groups[find(x)].append(rows[x][0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return [(len(sets[x]), least[find(x)]) for x in range(len(rows))]


def plain_near(rows):
    """(id, size, smallest reachable id) of every row."""
    return Counter((i, *found) for (i, _), found in zip(rows, plain_components(rows)))


def test_near_duplicates_of_odd_texts(odd, none):
    assert Counter(map(tuple, ngram_join.near_duplicates(odd).collect())) == plain_near(odd_texts())
    assert ngram_join.near_duplicates(none).collect() == []


@pytest.mark.parametrize("bound", [ngram_join.BROADCAST_ROWS, 0])
def test_near_duplicates_without_id(spark, monkeypatch, bound):
    """Near copies without id, also as bridges between ids and in copies of their own."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", bound)

    def changed(text, *places):
        return " ".join("changed" + str(p) if p in places else w for p, w in enumerate(text.split(" ")))

    base, bridge, alone = words(40, 120), words(41, 200), words(42, 120)
    rows = [(5, base), (None, changed(base, 60)), (None, changed(base, 60)), (30, changed(bridge, 10, 30, 50, 70)), (None, bridge),
            (31, changed(bridge, 110, 130, 150, 170)), (None, alone), (None, changed(alone, 60)), (None, words(43, 50))]
    expected = plain_near(rows)
    assert {(i, least) for i, _, least in expected} == {(5, 5), (None, 5), (30, 30), (None, 30), (31, 30), (None, None)}
    assert Counter(map(tuple, ngram_join.near_duplicates(docs_of(spark, rows)).collect())) == expected


@pytest.mark.parametrize("share", [0.0005, 0.2])
def test_near_duplicates_at_the_threshold(spark, monkeypatch, share):
    """Chains, small sets, sets of many sizes; with and without common elements."""
    monkeypatch.setattr(ngram_join, "COMMON", share)
    rnd, rows = random.Random(7), []
    passage = words(0, 30).split()
    for family in range(60):
        base = words(100 + family, rnd.choice([1, 3, 5, 6, 8, 9, 12, 20, 40, 150])).split()
        if family % 3 == 0:
            base += passage
        for _ in range(rnd.randint(1, 8)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(copy) // 25))):
                copy[rnd.randrange(len(copy))] = words(rnd.random(), 1)
            if rnd.random() < 0.3:
                base = copy
            rows.append((len(rows), " ".join(copy[: rnd.randint(max(1, len(copy) * 4 // 5), len(copy))])))
    assert Counter(map(tuple, ngram_join.near_duplicates(docs_of(spark, rows)).collect())) == plain_near(rows)


@pytest.mark.parametrize("commonness", [0.0, 0.5, 1.0])
def test_linked_sets_share_a_row(commonness):
    rnd = random.Random(3)
    for _ in range(1500):
        n = rnd.choice([1, 2, 3, 4, 5, 7, 8, 10, 15, 16, 31, 32, 64, 130])
        pool = np.unique(np.array([rnd.getrandbits(64) for _ in range(2 * n + 4)], np.uint64))
        order = rnd.sample(range(len(pool)), len(pool))
        k = rnd.randint(0, max(1, n // 3))
        d = rnd.randint(0, k)
        x, y = set(order[:n]), set(order[d:n]) | set(order[n : n + k - d])
        if not y or 4 * len(x & y) < 3 * len(x | y):
            continue
        common = np.sort(pool[np.array([rnd.random() < commonness for _ in pool])])
        a, b = (np.sort(pool[sorted(s)]) for s in (x, y))
        assert len(np.intersect1d(ngram_join.signatures(a, common), ngram_join.signatures(b, common)))
        assert ngram_join.differing(ngram_join.sketch_of(a), ngram_join.sketch_of(b)) <= len(x ^ y)


def test_sets_and_rows_are_those_of_each_text_alone():
    """Texts are hashed together, whatever their lengths, next to which others they stand."""
    texts = ["", None, " \t", "a", "A\x0bb", "ab\x00 c", "ab \x00c", "x " * 9, "w" * 64, "w" * 65, "w" * 7 + "v", "w" * 8, "w" * 9]
    texts += [words(1, 300), words(1, 299), words(2, 4) + " \u00c9 \u00e9", "a b c d E", "a b c d e", "a b c d", "b c d e"]
    encoded = [None if t is None else t.encode() for t in texts]
    sets = ngram_join.shingle_sets(encoded)
    alone = [ngram_join.shingle_sets([t])[0] for t in encoded]
    assert all(np.array_equal(x, y) for x, y in zip(sets, alone))
    column = ngram_join.pa.array(texts, "string")
    for size in (1, 700):
        runs = [x for run in ngram_join.sets_in(column, size=size) for x in run]
        assert len(runs) == len(sets) and all(np.array_equal(x, y) for x, y in zip(runs, sets))
    plain = []
    for text in encoded:
        parts = re.findall(rb"[^\x20\x09-\x0D]+", (text or b"").lower())
        plain.append({tuple(parts[p : p + 5]) for p in range(max(1, len(parts) - 4))} if parts else set())
    for i, x in enumerate(sets):
        assert all(len(np.intersect1d(x, y)) == len(plain[i] & plain[j]) for j, y in enumerate(sets))
    some = [x for x in sets if len(x)]
    for common in (np.zeros(0, np.uint64), np.unique(np.concatenate(some))[::2]):
        rows, owner = ngram_join.signature_rows(some, ngram_join.Common(common))
        for i, x in enumerate(some):
            assert np.array_equal(np.sort(rows[owner == i]), np.sort(ngram_join.signatures(x, common)))


def test_sketches_are_compared_together_as_one_by_one(monkeypatch):
    monkeypatch.setattr(ngram_join, "COMPARED", 3)
    rnd = np.random.default_rng(5)
    sketches = [ngram_join.sketch_of(rnd.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 60, 70, 130, 500, 900, 70_000)]
    pairs = [(a, b) for a in sketches for b in sketches]
    left, right = zip(*pairs)
    for most in (0, 10, 60, 300):
        found = ngram_join.nearby(left, right, np.full(len(pairs), most))
        assert found.tolist() == [ngram_join.differing(a, b) <= most for a, b in pairs]
    assert len(ngram_join.nearby([], [], np.zeros(0, np.int64))) == 0


def test_near_duplicates_without_broadcasts(spark, odd, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    assert Counter(map(tuple, ngram_join.near_duplicates(odd).collect())) == plain_near(odd_texts())


# Operator 4


def plain_gone(rows):
    """Per different (id, text) which bytes go, by looking at every window in order."""
    found, seen = {}, set()
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda r: r[:2])
    for some, i, text in order:
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        found[i if some else None, text] = gone
    return found


def plain_repeats(rows):
    """Per row what stays."""
    known = {}
    for (i, text), gone in plain_gone(rows).items():
        data = text.encode()
        runs = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        known[i, text] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return Counter((i, *known[i, t or ""]) for i, t in rows)


def test_repeated_strings_of_odd_texts(odd, none):
    assert Counter(map(tuple, suffix_dedup.digests(odd).collect())) == plain_repeats(odd_texts())
    assert suffix_dedup.digests(none).collect() == []
    kept = suffix_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    texts = {r.doc_id: r.text for r in kept.filter("doc_id IN (1, 2, 7, 14)").collect()}
    assert texts[1] is None and texts[2] == "" and texts[14] == "x"


@pytest.mark.parametrize("chunk", [150, 400, 1 << 19])
def test_repeated_strings(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    monkeypatch.setattr(suffix_dedup.chunks, "__defaults__", (chunk,))
    rnd, rows = random.Random(11), []
    parts = [words(i, rnd.randint(5, 40)) for i in range(12)]
    for i in range(150):
        text = " ".join(rnd.choice(parts) if rnd.random() < 0.7 else words(rnd.random(), 12) for _ in range(rnd.randint(1, 6)))
        if i % 10 == 0:
            text = rnd.choice(["ab", "x", "0123456789"]) * rnd.randint(30, 200) + text
        rows.append((i, text))
    rnd.shuffle(rows)
    assert Counter(map(tuple, suffix_dedup.digests(docs_of(spark, rows)).collect())) == plain_repeats(rows)


def test_characters_stay_whole(spark):
    shared = "ż" * 10 + words(1, 40)
    rows = docs_of(spark, [(1, "a" + shared + "b"), (2, "ó" + shared + "é")])
    first, second = (r.text for r in suffix_dedup.deduplicated(rows).orderBy("doc_id").collect())
    assert first == "a" + shared + "b" and second == "óé"


def test_suffixes_are_in_order(monkeypatch):
    from lotwise.llm import induced

    rnd = random.Random(0)
    for _ in range(400):
        monkeypatch.setattr(induced, "BLOCK", rnd.choice([1, 3, 64]))
        monkeypatch.setattr(induced, "MEMORY", rnd.choice([0, 200, 10**9]))
        text = [rnd.randint(1, rnd.choice([1, 2, 5])) for _ in range(rnd.randint(1, 60))]
        text = np.array(text + (text[: len(text) // 2] + text if rnd.random() < 0.5 else []) + [0])
        depth = rnd.choice([1, 3, 8, 100])
        order, common = suffix_order(text, depth)
        suffixes = [tuple(text[i : i + depth].tolist()) for i in range(len(text))]
        assert sorted(order.tolist()) == list(range(len(text)))
        for i in range(1, len(text)):
            a, b = suffixes[order[i - 1]], suffixes[order[i]]
            assert a >= b
            assert common[i] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_a_shard_is_sorted_in_little_memory():
    import tracemalloc

    import numpy as np

    from lotwise.llm import suffix_dedup

    text = np.random.default_rng(5).integers(97, 123, suffix_dedup.SHARD, np.uint8).tobytes()
    half = len(text) // 2
    tracemalloc.start()
    found = suffix_dedup.removed_in([(0, text[:half]), (7, text[half - 150 :])])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(1, 7, 157)] and peak < 200e6
