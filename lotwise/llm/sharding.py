"""Operator 8: shards as runs of a Hilbert order over several metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, numbered, stored, table
from lotwise.llm.hilbert import index_column

SHARDS = 24
#: Levels of each dimension are 2**BITS; three dimensions make at most 4096 cells.
BITS = 4


def _text_number(column: str, low: str, high: str) -> Column:
    """Order-keeping number of a string: the six bytes after what the extremes share."""
    a, b = low.encode(), high.encode()
    shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tail = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), shared + 1, 6)), 12, "0")
    return F.conv(tail, 16, 10).cast("double")


def quantised(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """Add ``_q0``, ``_q1``, ...: each dimension cut evenly between its smallest and largest
    value into 2**bits cells, in its order. Null (and not-a-number) is cell 0."""
    names = [f"_d{i}" for i in range(len(dimensions))]
    kinds = dict(rows.dtypes)
    if texts := [d for d in dimensions if kinds[d] == "string"]:
        ends = rows.agg(*(f(d).alias(f"{n}_{d}") for d in texts for n, f in (("low", F.min), ("high", F.max)))).first()
    numbers = [
        _text_number(d, ends[f"low_{d}"] or "", ends[f"high_{d}"] or "") if d in texts else F.col(d).cast("double")
        for d in dimensions
    ]
    rows = rows.withColumns({n: F.when(~F.isnan(c), c) for n, c in zip(names, numbers)})
    ends = rows.agg(*(f(n).alias(f"{k}{n}") for n in names for k, f in (("low", F.min), ("high", F.max)))).first()
    cells = {}
    for i, n in enumerate(names):
        low, high = ends[f"low{n}"] or 0.0, ends[f"high{n}"] or 0.0
        width = (high - low) or 1.0
        cell = F.least(F.floor((F.col(n) - low) / width * 2**bits), F.lit(2**bits - 1))
        cells[f"_q{i}"] = F.coalesce(cell, F.lit(0)).cast("int")
    return rows.withColumns(cells).drop(*names)


def sharded(rows: DataFrame, dimensions: list[str], key: list[str], shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Add ``shard`` and ``slot``: rows in the order of their cell's place on the curve are
    cut into runs whose counts differ by one at most (law ``rows``). Rows of one cell, and
    so of one run of files, are near in every dimension; a reader that filters on some of
    them skips most files. A crowded cell is numbered in many hash buckets of ``key``, and
    may fill several shards. ``rows`` should be a stored table; it is read a few times.
    Repeated rows get slots of their own; an empty table gives an empty one. Input columns
    called shard or slot are replaced; others stay."""
    total = rows.count()
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    places = [F.col(d).alias(f"_x{i}") for i, d in enumerate(dimensions)]
    rows = rows.select(F.struct(*kept).alias("row"), F.struct(*key).alias("key"), *places)
    rows = quantised(rows, [f"_x{i}" for i in range(len(dimensions))], bits)
    cells = [f"_q{i}" for i in range(len(dimensions))]
    # The cells number 2**(bits * dimensions) at most, whatever the number of rows.
    curve = rows.select(cells).distinct().withColumn("_curve", index_column(cells, bits))
    ordered = numbered(rows.join(F.broadcast(curve), cells), ["_curve"], ["key"])
    shard = F.expr(f"position * {shards} div {max(1, total)}")
    first = F.expr(f"(_shard * {total} + {shards - 1}) div {shards}")
    return ordered.withColumn("_shard", shard).select(
        "row.*", F.col("_shard").cast("int").alias("shard"), (F.col("position") - first).cast("long").alias("slot")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 24 shards, ordered over size, source and language."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.log2(F.octet_length(text) + 8).alias("_magnitude"),
        "source",
        "lang",
    )
    rows = sharded(stored(docs, "metadata"), ["_magnitude", "source", "lang"], ["text_crc32", "size", "doc_id"])
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


by_value(__name__)
