"""The whole pipeline on planted documents, against plain versions of its stages."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import bpe, packing, toxicity
from tests.llm.conftest import docs_of, words
from tests.llm.test_texts import best_fit, check_packing, plain_components, plain_gone

SF = "/root/testdata/sf0.01"


def planted(given, toxic):
    """Given documents, and some of known fate."""
    base, other, passage = words(31, 120), words(32, 90), words(33, 60)
    near = base.split(" ")
    near[60] = "changed"
    rows = given + [(10_000 + i, text) for i, text in enumerate(toxic)]
    return rows + [
        (20_005, base), (20_016, base), (20_016, other), (20_017, " ".join(near)), (20_018, None), (20_019, ""), (None, base), (None, other + " tail"),
        (20_020, words(34, 40) + " " + passage + " " + words(35, 40)), (20_021, words(36, 40) + " " + passage + " " + words(37, 40)),
        (20_022, "<|endoftext|> " + words(38, 2000)), (20_005, base),
    ]


def test_run_as_plain_stages(spark, tmp_path):
    import corpus_pipeline as pipeline
    import tokenizers

    whole, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    some = whole.filter("doc_id < 450").orderBy("doc_id").collect()
    marked = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    toxic = [r.text + " end" for r in some if r.doc_id in marked][:6]
    assert toxic
    rows = planted([(r.doc_id, r.text) for r in some], toxic)
    folder = str(tmp_path)
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    found = pipeline.run(spark, folder).collect()

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit_on(docs, labels)
    rated = toxicity.scored(docs, model).select("doc_id", "text", "predicted").collect()
    kept = [(r.doc_id, r.text) for r in rated if r.predicted == 0]
    assert 0 < len(rows) - len(kept) < 60
    kept = [row for row, (_, least) in zip(kept, plain_components(kept)) if row[0] is None or least >= row[0]]
    ids = Counter(i for i, _ in kept)
    assert ids[20_016] == 1 and ids[20_017] == 0 and ids[20_005] == 2 and ids[None] == 2
    gone, cut = plain_gone(kept), []
    for i, text in kept:
        at, left = 0, []
        for c in text or "":
            size = len(c.encode())
            if not all(gone[i, text][at : at + size]):
                left.append(c)
            at += size
        cut.append((i, "".join(left)))
    assert sum(len(t or "") for _, t in kept) - sum(len(t) for _, t in cut) > 200
    plain, expected, lengths = tokenizers.Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json")), Counter(), []
    for i, text in cut:
        own = plain.encode(text, add_special_tokens=False).ids + [2]
        for piece, (start, length) in enumerate(packing.pieces_of(len(own), 1024)):
            expected[i, piece, start, length, zlib.crc32(np.array(own[start : start + length], "<u4").tobytes())] += 1
            lengths.append(length)
    assert check_packing(found, expected, 1024) == best_fit(lengths, 1024)


def test_run_on_an_empty_table(spark, tmp_path, none):
    import corpus_pipeline as pipeline

    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_texts_of_one_id_are_told_apart(spark):
    import corpus_pipeline as pipeline

    a, b = words(41, 100), words(42, 100)
    docs = docs_of(spark, [(5, a), (16, a), (16, b)]).withColumn("mark", F.lit(1)).withColumn("component", F.lit("c"))
    left = dict(pipeline.STAGES)["near duplicates"](spark, docs, SF)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(5, a), (16, b)])


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from lotwise.llm import common

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="app"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(session)
    session.sparkContext.master = "local[8]"
    assert common.shared_folder(session).endswith("/app")
