"""Operator 9: byte-level BPE encoding and decoding of whole texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, table, with_fields
from lotwise.llm.tokens import TreeEncoder, joined


def vocabulary_path(name: str = "byte_bpe_multi_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, text: str = "text", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (their bytes). A null text counts as empty:
    no ids, no bytes. Repeated rows are encoded each for itself; other columns stay, but
    input columns called ``ids`` or ``decoded`` are replaced."""
    kept = docs.drop("ids", "decoded")

    def run(encoder, batch):
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        found = [np.frombuffer(encoder.encode(t or ""), "<u4") for t in texts]
        offsets = np.cumsum([0, *map(len, found)])
        values = np.concatenate([*found, np.empty(0, "<u4")]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
        decoded = pa.array([encoder.decode(x) for x in found], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, ids, decoded], [*batch.schema.names, "ids", "decoded"])

    return _mapped(kept, run, ranks, pattern, "ids array<int>, decoded binary")


def digests(docs: DataFrame, text: str = "text", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encode`` with counts and hashes in place of ids and bytes: n_tokens, ids_sha256 (of
    the decimal ids joined by commas) and decoded_sha256, made in the tasks that encode."""

    def run(encoder, batch):
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        counts, ids_sha, decoded_sha = [], [], []
        for t in texts:
            ids = np.frombuffer(encoder.encode(t or ""), "<u4")
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(joined(encoder.written_ids, ids)[:-1]).hexdigest())
            decoded_sha.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
        others = [n for n in batch.schema.names if n != text]
        made = [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
        return pa.RecordBatch.from_arrays(
            [batch.column(n) for n in map(batch.schema.get_field_index, others)] + made,
            [*others, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _mapped(docs, run, ranks, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", (text,))


def _mapped(docs: DataFrame, run, ranks: str | None, pattern: str | None, made: str, drop: tuple = ()) -> DataFrame:
    ranks, pattern = ranks or vocabulary_path(), pattern or split_pattern()

    def batches(rows):
        encoder = TreeEncoder.of(ranks, pattern)
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                yield run(encoder, batch.slice(at, 256))

    return docs.mapInArrow(batches, with_fields(docs, made, drop))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and what they decode to."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))


by_value(__name__)
