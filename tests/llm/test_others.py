"""Operators on vectors, tables and pages, the classifier and the pipeline."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import hilbert, neighbours, ngram_join, packing, sharding, topk, toxicity, warc
from lotwise.llm.components import components, extended
from tests.llm.conftest import docs_of, odd_texts

SF = "/root/testdata/sf0.01"


# Operators 3 and 7


def odd_vectors():
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 460)]
    rows += [
        (500, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [math.nan] * 6), (650, [math.inf] * 6), (700, [0.0] * 6), (750, []),
        (None, [1.0] * 6), (800, [1.0, 2.0]), (801, [2.0, 4.1]), (850, [3.0] * 7), (900, [1e-30] * 6), (950, [1e30, 1.0, 1.0, 1.0, 1.0, 1.0]),
        (7, rows[7][1]), (1000, [-1.0, 0.5, 0.0, 0.0, 0.0, 0.0]),
    ]
    return rows


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, score long, _keys long")


def taking_part(rows):
    fine = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            fine[i] = min(fine.get(i, v), v)
    return fine


def test_top_products(spark, monkeypatch):
    rows = [(i, [x if x is None or abs(x) < 1e6 else math.copysign(1e4, x) if math.isfinite(x) else x for x in v] if v else v) for i, v in odd_vectors()]
    expected = set()
    fine = {i: [math.floor(1024 * x) for x in v] for i, v in taking_part(rows).items()}
    for q in fine:
        if q % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q and len(v) == len(fine[q])]
            expected |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:10], 1)}
    for block, queries in ((4096, 1024), (50, 3)):
        monkeypatch.setattr(topk, "BLOCK", block)
        monkeypatch.setattr(topk, "QUERIES", queries)
        found = topk.top_products(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()
        assert Counter(map(tuple, found)) == Counter(expected)
    assert topk.top_products(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.top_products(vectors(spark, rows), F.lit(False)).collect() == []


def test_products_of_large_components(spark):
    rows = [(0, [1e9, 1e9, 1.0]), (1, [1e9, -1e9, 3.0]), (2, [-1e9, 1e9, 1.0]), (3, [0.0, 0.0, 2.0]), (4, [1.0, 1.0, 1.0])]
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    scores = sorted((-sum(a * b for a, b in zip(whole[0], v)), i) for i, v in whole.items() if i)
    found = topk.top_products(vectors(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(i, -s) for s, i in scores]
    with pytest.raises(Exception, match="more than 64 bits"):
        topk.top_products(vectors(spark, [(0, [1e30]), (1, [1e30])]), F.col("vec_id") == 0).collect()


def test_sparse_products():
    rng = np.random.default_rng(0)
    for _ in range(20):
        q, c = (rng.integers(-9, 9, (n, 12)) * (rng.random((n, 12)) < 0.3) for n in (5, 40))
        assert (topk.scatter(q, c) == q @ c.T).all()


@pytest.mark.parametrize("block", [4096, 20])
def test_neighbours_of_odd_vectors(spark, monkeypatch, block):
    """With two ranges a query sees all rows, so what is found is exact."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    fine = {i: np.array(v, float) for i, v in taking_part(odd_vectors()).items() if any(v)}
    found = defaultdict(dict)
    for r in neighbours.nearest(vectors(spark, odd_vectors()), F.col("vec_id") % 50 == 0, ranges=2, curves=2).collect():
        found[r.query_id][r["rank"]] = (r.vec_id, r.score)
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in fine.items()}
    for q in fine:
        if q % 50:
            continue
        scores = sorted((-round(float(unit[q] @ v), 9), i) for i, v in unit.items() if i != q and len(v) == len(unit[q]))[:5]
        got = found.pop(q, {})
        assert sorted(got) == list(range(1, len(scores) + 1))
        assert [(-round(got[n][1], 9), got[n][0]) for n in sorted(got)] == scores
    assert not found
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_neighbours_of_few_vectors_and_of_one_key(spark):
    """By default: 1 to 30 vectors of a length of their own beside 400 of another, and 300
    moved copies of one vector, which have its key, beside 60 others. All are queries."""
    rng = np.random.default_rng(8)
    groups = {n + 1: rng.normal(size=(n, n + 1)) for n in range(1, 31)} | {40: rng.normal(size=(400, 40))}
    one, others = rng.normal(size=50), rng.normal(size=(60, 50))
    moved = one * rng.uniform(0.5, 2, (300, 1)) + rng.normal(size=(300, 50)) * 1e-5
    groups[50] = np.concatenate([others[:30], moved, others[30:]])
    rows = [(size * 1000 + i, v.tolist()) for size, group in groups.items() for i, v in enumerate(group)]
    found = defaultdict(dict)
    for r in neighbours.nearest(vectors(spark, rows), F.lit(True)).collect():
        found[r.query_id][r["rank"]] = (r.vec_id, r.score)
    for size, group in groups.items():
        unit = group / np.linalg.norm(group, axis=1, keepdims=True)
        for i in range(len(group)):
            scores = sorted((-round(float(unit[i] @ v), 9), size * 1000 + j) for j, v in enumerate(unit) if j != i)[:5]
            got = found.pop(size * 1000 + i, {})
            assert sorted(got) == list(range(1, len(scores) + 1)), (size, i)
            if size <= 31:
                assert [(-round(got[n][1], 9), got[n][0]) for n in sorted(got)] == scores
            if size == 50 and 30 <= i < 330:
                assert all(50_030 <= j < 50_330 for j, _ in got.values())
    assert not found


@pytest.mark.parametrize("keys", [[3] * 500, list(range(200)), [1, 2, 3] * 90, [0] * 100 + [5] * 900 + list(range(6, 300)), list(range(100))])
def test_ranges_are_occupied(monkeypatch, keys):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    keys = np.sort(keys)
    ends = keys[[-(-len(keys) * i // 24) - 1 for i in range(1, 24)]]
    at, parts = neighbours.ranges_of(ends, keys[0], len(keys), 5, 24)
    sizes = np.bincount(np.searchsorted(at, keys, side="right"), minlength=len(at) + 1)
    assert len(parts) == len(sizes) and (sizes > 0).all() and (sizes <= 2 * 50 * parts).all()
    beside = np.convolve(sizes, [1, 1, 1], "same") if len(sizes) > 1 else sizes
    assert (beside >= min(len(keys), 6)).all()


def test_neighbours_are_mostly_found(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, all_vectors = np.array([r.vec_id for r in given]), np.array([r.embedding for r in given], float)
    unit = all_vectors / np.linalg.norm(all_vectors, axis=1, keepdims=True)
    found = defaultdict(set)
    for r in neighbours.op3_neighbours(spark, SF).collect():
        found[r.query_id].add(r.vec_id)
    share = []
    for place in np.flatnonzero(ids % 50 == 0):
        scores = unit @ unit[place]
        scores[place] = -2
        share.append(len(found[ids[place]] & set(ids[np.argsort(-scores)[:5]])) / 5)
    assert np.mean(share) >= 0.9


# Operator 8


@pytest.mark.parametrize(("axes", "bits"), [(1, 4), (2, 3), (3, 2), (4, 1)])
def test_curve_is_connected(spark, axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    index = hilbert.indices(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()
    names = [f"_q{i}" for i in range(axes)]
    rows = spark.createDataFrame([tuple(map(int, c)) for c in cells], ", ".join(f"{n} int" for n in names))
    assert [r[0] for r in rows.select(hilbert.index_column(names, bits)).collect()] == index.tolist()


def check_shards(rows, n, shards):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == n and all(0 <= s < shards for s in sizes)
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(shards)), default=0) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == sorted((s, p) for s, k in sizes.items() for p in range(k))


def test_shards(spark, odd, none):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    check_shards(sharding.op8_sharding(spark, SF).collect(), given.count(), 24)
    for dimensions in (["n_chars", "source", "lang"], ["doc_id"], ["text", "n_chars"]):
        rows = sharding.sharded(odd, dimensions, ["doc_id", "text"], shards=4).collect()
        check_shards(rows, odd.count(), 4)
        assert Counter((r.doc_id, r.text, r["rank"], r["row"]) for r in rows) == Counter((r.doc_id, r.text, r["rank"], r["row"]) for r in odd.collect())
    assert sharding.sharded(none, ["n_chars", "source"], ["doc_id"]).collect() == []


def test_runs_follow_the_curve(spark):
    """Rows in the order of shard and slot never go back on the curve."""
    rows = spark.range(4000).selectExpr("id", "cast(id * 7919 % 64 as double) x", "cast(id * 104729 % 61 as double) y", "'s' || id % 5 s")
    found = sharding.sharded(rows, ["x", "y", "s"], ["id"], shards=7).orderBy("shard", "slot").collect()
    q = lambda v, low, high: min(15, math.floor((v - low) / (high - low) * 16))
    code = {f"s{i}": float(int.from_bytes(str(i).encode().ljust(6, b"\0"), "big")) for i in range(5)}
    cells = np.array([[q(r.x, 0, 63), q(r.y, 0, 60), q(code[r.s], code["s0"], code["s4"])] for r in found])
    assert (np.diff(hilbert.indices(cells, 4)) >= 0).all()


# Operator 10


def test_archives(spark, tmp_path):
    large, other = "<p>" + "ż" * 40_000, "x" * 1000
    rows = [
        (1, "https://a.example/1", large), (5, "https://a.example/5", large), (3, None, large), (2, "u\r\nInjected: 1", ""), (4, "ü ", None),
        (6, "u", other), (9, "u", other), (7, "u", "x" * 999), (8, "u", "x" * 999), (None, "u", "no id"), (10, "u", "a\r\n\r\nWARC/1.1\r\n0\r\n"),
        (11, "u", "\n" * 3000), (12, "u", "y" * 16_384 * 3), (13, "u", "same row"), (13, "u", "same row"),
    ]
    pages = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, digest string, block int")
    folder = str(tmp_path / "archives")
    warc.written(pages, folder, segment=1000, per_file=3)
    found = warc.read(spark, folder, with_payload=True).collect()
    keeper = {large: 5, other: 9}
    expected = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        refers = keeper.get(html) if keeper.get(html) != page else None
        expected[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers, data] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in found) == expected
    empty = str(tmp_path / "empty")
    warc.written(pages.limit(0), empty)
    assert warc.read(spark, empty).collect() == []


def test_a_missing_segment_fails(spark, tmp_path):
    import glob
    import os

    pages = spark.createDataFrame([(1, "u", "y" * 5000)], "page_id long, url string, html string")
    folder = str(tmp_path / "archives")
    warc.written(pages, folder, segment=1000, per_file=1)
    os.remove(sorted(glob.glob(f"{folder}/*.gz"))[2])
    with pytest.raises(Exception, match="not complete"):
        warc.read(spark, folder).collect()


def test_archives_of_other_writers(spark, tmp_path):
    """A member a record, other record types, plain framing, base-32 digests, odd header lines."""
    import base64
    import gzip

    def made(kind, block, *more):
        return "\r\n".join(["WARC/1.0", f"warc-type:{kind}", *more, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"

    http, body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n", b"plain body \r\n\r\n WARC/1.0"
    digest = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    records = [
        made("warcinfo", b"software: x\r\n", "WARC-Record-ID: <a>"),
        made("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID: <b>"),
        made("response", http + body, "WARC-Record-ID: <c>", "WARC-Target-URI: http://a.example/", "X-Folded: one", "\ttwo", f"WARC-Payload-Digest: {digest}"),
        made("response", b"HTTP/1.1 200 OK\r\ntransfer-encoding:  Chunked\r\n\r\n" + warc.chunked(body, 5), "WARC-Record-ID: <d>", "WARC-Target-URI: u2"),
        made("revisit", http, "WARC-Record-ID: <e>", "WARC-Target-URI: u3", "WARC-Refers-To: <c>", f"WARC-Payload-Digest: {digest}"),
    ]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "many.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "w" / "one.warc.gz").write_bytes(gzip.compress(b"".join(records[:3]).replace(b"<c>", b"<f>")))
    (tmp_path / "w" / "plain.warc").write_bytes(b"".join(records[2:4]).replace(b"<c>", b"<g>").replace(b"<d>", b"<h>"))
    found = warc.read(spark, str(tmp_path / "w"), with_payload=True).collect()
    assert Counter(r.uri for r in found) == {"http://a.example/": 3, "u2": 2, "u3": 1}
    assert all(bytes(r.payload) == body and r.page_id is None and r.payload_digest == hashlib.sha1(body).hexdigest() for r in found)
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "lost.warc.gz").write_bytes(gzip.compress(records[4]))
    with pytest.raises(Exception, match="no response"):
        warc.read(spark, str(tmp_path / "v")).collect()
    (lost,) = warc.read(spark, str(tmp_path / "v"), strict=False).collect()
    assert lost.payload_bytes is None and lost.payload_digest == hashlib.sha1(body).hexdigest()
    for cut in (gzip.compress(records[2])[:-9], records[2][:-30], records[2][:40]):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.parsed(cut))


def test_records_have_what_the_format_asks(spark, tmp_path):
    import glob

    rows = [(1, "https://a.example/1", "x" * 3000), (2, "https://a.example/2", "x" * 3000), (3, "u", "y")]
    folder = str(tmp_path / "archives")
    warc.written(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, segment=1000)
    records = [h for f in glob.glob(f"{folder}/*.gz") for h, _ in warc.parsed(open(f, "rb").read())]
    ids = {h["warc-record-id"] for h in records}
    assert len(ids) == len(records)
    for h in records:
        assert {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-target-uri"} <= h.keys()
        if h["warc-type"] == "revisit":
            assert h["warc-profile"] == warc.PROFILE and h["warc-refers-to"] in ids
        elif h["warc-type"] == "response":
            assert h["content-type"].startswith("application/http")


@pytest.mark.parametrize("size", [0, 1, 4095, 4096, 4097, 20_000])
def test_chunks(size):
    payload = bytes(i * 31 % 256 for i in range(size))
    body = warc.chunked(payload)
    assert warc.unchunked(body) == payload
    with pytest.raises(ValueError):
        warc.unchunked(body[:-6])


# Operator 2


def test_scores_of_odd_texts(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(-3, 25)] + [(3, None), (4, 0), (4, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_on(odd, labels)
    rows = toxicity.scored(odd, model)
    assert set(rows.columns) == set(odd.columns) and rows.count() == odd.count()
    assert rows.filter("score IS NULL OR score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0
    by_text = defaultdict(set)
    for r in rows.collect():
        by_text[r.text or ""].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    nothing = toxicity.fit_on(none, labels)
    assert toxicity.scored(none, nothing).collect() == []
    assert toxicity.scored(odd, nothing).filter("predicted = 1").count() == 0


@pytest.mark.parametrize("size", [0, 50_000, 19_000])
def test_one_long_text_leaves_the_sample_whole(spark, monkeypatch, size):
    """The first text in the order of hashes is longer than the bound, or nearly so."""
    monkeypatch.setattr(toxicity, "MAX_BYTES", 20_000)
    samples = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: samples.append((texts, toxic)))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int").filter(~toxicity.held_out())
    order = [(r.doc_id, r.toxic) for r in labels.orderBy(F.xxhash64("doc_id")).collect()]
    docs = {i: f"{i} " + "x" * 80 for i, _ in order}
    docs[order[0][0]] += "x" * size
    toxicity.fit_on(docs_of(spark, list(docs.items())), labels)
    expected = [(docs[i], y) for i, y in order[1 if size else 0 :]]
    assert list(zip(*samples[0])) == expected and {y for _, y in expected} == {0, 1}


def test_held_out_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit_on(docs, labels).key() == toxicity.fit_on(docs, turned).key()


def test_held_out_accuracy(spark):
    larger = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op2_toxicity(spark, larger).filter("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean(toxic) > 0.6 and np.mean(clean) < 0.02


# Components and the pipeline


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(300, 400)] + [(0, i) for i in range(1, 60)] + [(500, 500)]
    edges += [(rnd.randrange(600, 800), rnd.randrange(600, 800)) for _ in range(120)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: find(n) for n in linked}
    first, later = ([e for i, e in enumerate(edges) if (i % 3 == 0) == turn and e[0] != e[1]] for turn in (True, False))
    rows = lambda e: spark.createDataFrame(e, "a long, b long")
    grown = extended(components(rows(first)), rows(later))
    assert {r.node: r.label for r in grown.collect()} == found
    assert {r.node: r.label for r in extended(grown, rows([])).collect()} == found


def test_pipeline_stages(spark, odd, none):
    import corpus_pipeline as pipeline

    names = [name for name, _ in pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "repeated text", "packing"]
    stages = dict(pipeline.STAGES)
    kept = stages["toxicity"](spark, odd, SF)
    assert kept.columns == odd.columns
    near = stages["near duplicates"](spark, odd, SF)
    assert near.columns == odd.columns
    components_of = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(odd).collect() if r.doc_id is not None}
    expected = Counter(i for i, _ in odd_texts() if i is None or components_of[i] >= i)
    assert Counter(r.doc_id for r in near.collect()) == expected
    cut = stages["repeated text"](spark, near, SF)
    assert cut.columns == odd.columns and cut.count() == near.count()
    assert cut.filter("text IS NOT NULL AND n_chars <> length(text)").count() == 0
    pieces = stages["packing"](spark, cut, SF)
    assert pieces.select("doc_id").distinct().count() == cut.select("doc_id").distinct().count()
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []


def test_registered_queries():
    import __spark_entry__ as contract

    numbers = Counter(name.split("_")[0] for name in contract.queries() if name.startswith("op"))
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}
    assert "pipeline" in contract.queries() and contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", ["op1_licenses", "op6_ngram_join", "op7_topk", "op11_negatives", "op13_divergence"])
def test_same_result_as_sql(spark, name):
    import __spark_entry__ as contract
    from verification.compare import connect, difference

    small = "/root/testdata/sf0.001"
    assert difference(contract.queries()[name](spark, small), connect(small), contract.oracle_sql()[name]) is None
