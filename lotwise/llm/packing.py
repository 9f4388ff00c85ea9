"""Operator 5: best-fit packing planned over a histogram of lengths."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.bpe import split_pattern, vocabulary_path
from lotwise.llm.common import by_value, in_parts, numbered, stored, table
from lotwise.llm.tokens import TreeEncoder

CAPACITY = 1024
END_ID = 2
#: Segments kept per worker process (about 40 MB): short ones are cheap to encode again here.
CACHE = 200_000


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, the first one the rest."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def added_tokens(path: str) -> tuple[tuple[str, int], ...]:
    """Strings and ids that a tokenizer's file adds to its vocabulary: its library finds them in
    any text before all else."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"only plain added tokens are known, not {token}")
    return tuple((token["content"], token["id"]) for token in added)


def tokenized(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    ranks: str | None = None, pattern: str | None = None, with_ids: bool = True, special: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece: key, piece (from 0), start, length, ids_crc32 and, if asked for,
    ids. Null and empty texts are one piece of the end id alone. ``special`` strings have ids of
    their own wherever they stand in a text; by default those that the tokenizer's file adds."""
    ranks, pattern = ranks or vocabulary_path("byte_bpe_50k.tiktoken"), pattern or split_pattern()
    special = added_tokens(vocabulary_path("byte_bpe_50k.json")) if special is None else tuple(special.items())

    def batches(rows):
        encoder, end = TreeEncoder.of(ranks, pattern, True, special, CACHE), np.array([end_id], "<u4").tobytes()
        for batch in in_parts(rows):
            found = []
            for document, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(value or "") + end
                for piece, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    found.append((document, piece, start, length, zlib.crc32(own), np.frombuffer(own, "<u4") if with_ids else None))
            columns = list(zip(*found)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, (batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["_key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(columns[5], pa.list_(pa.uint32())).cast(pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(batches, schema).withColumnRenamed("_key", key)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: (length, first rank, ranks, first sequence,
    offset). Pieces with those ranks of that length go to as many following sequences.
    Sequences with equal room are kept as ranges, so the work grows with the number of
    different lengths, not with that of pieces."""
    room: dict[int, list[tuple[int, int]]] = {}
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            fit = min((r for r in room if r >= length), default=None)
            if fit is None:
                # No open sequence has room: each new one takes as many of them as it holds.
                each = capacity // length
                for new, fill in ((left // each, each), (1 if left % each else 0, left % each)):
                    if not new:
                        continue
                    for turn in range(fill):
                        slots.append((length, rank, new, sequences, turn * length))
                        rank += new
                    if capacity - fill * length:
                        room.setdefault(capacity - fill * length, []).append((sequences, new))
                    sequences += new
                break
            first, count = room[fit].pop()
            taken = min(count, left)
            slots.append((length, rank, taken, first, capacity - fit))
            rank, left = rank + taken, left - taken
            if taken < count:
                room[fit].append((first + taken, count - taken))
            if not room[fit]:
                del room[fit]
            if fit > length:
                room.setdefault(fit - length, []).append((first, taken))
    return slots


def packed(pieces: DataFrame, key: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset``. ``pieces`` has ``length`` (1 to ``capacity``) and a
    ``key``; rows that agree in it must be equal, so that it does not matter which of them takes which place. It is read four times, so it should be a stored table. Its histogram, at
    most ``capacity`` rows, is all that the driver sees. Input columns called sequence_id or
    offset are replaced; others stay. An empty input gives an empty result."""
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(F.struct(*kept).alias("row"), "length", F.struct(*key).alias("key"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan(histogram, capacity), "_length long, _first long, _ranks long, _sequence long, offset long")
    ranked = numbered(pieces, ["length"], ["key"])
    here = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_first") + F.col("_ranks"))
    # The plan is bounded by the capacity (a few thousand ranges), however many pieces there are.
    return ranked.join(F.broadcast(slots), here).select(
        "row.*", (F.col("_sequence") + F.col("rank") - F.col("_first")).alias("sequence_id"), "offset"
    )


def packed_documents(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places. Repeated and null ids are packed row by row:
    pieces that agree in id, number, start, length and ids are the same."""
    return packed(stored(tokenized(docs, with_ids=with_ids), "pieces"), ["doc_id", "piece", "start", "length", "ids_crc32"])


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))


by_value(__name__)
