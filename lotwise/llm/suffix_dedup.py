"""Operator 4: removal of repeated 100-byte strings by suffix arrays of shards.

Suffix arrays of shards need all places of a string in one shard. Every window of ``SPAN``
bytes has an *anchor*, the gram of ``GRAM`` bytes in it that comes first in an order of hashes;
equal windows have equal anchors. Consecutive windows with the same anchor make a *region*.
So a window's repetitions are all found among the regions of one anchor:

* an anchor with one region only has no repetitions, and that is most of the text;
* of equal regions all but the earliest are removed whole, without comparing anything;
* the different regions of one anchor go to a shard, whose suffixes are sorted by external
  induction (``induced.py``). Suffixes with ``SPAN`` bytes in common are neighbours there.

Grams that very many documents hold come last in the order. A passage that a third of all
documents quote would else be the anchor of as many different regions, one for each text
around it; so only windows inside of it have such an anchor, and these regions are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, free_names, in_parts, release_worker, stored, table
from lotwise.llm.induced import Hashes, suffix_order

SPAN, GRAM = 100, 32
#: Bytes of text that are hashed at once; places in it take 20 bits.
CHUNK = 1 << 19
#: Counters of grams, and the share of documents from which on a gram is common.
COUNTERS, COMMON = 1 << 22, 0.005
#: Bytes of regions sorted together, if their anchors allow it. Sorting takes some 70 bytes for
#: each of them, in every task of an executor at once.
SHARD = 1_500_000
#: Documents whose bytes and regions are held at once.
DOCUMENTS = 2048

_PLACE = np.uint64((1 << 20) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes], size: int = CHUNK):
    """(bytes, documents, starts in them, starts in the bytes) of several documents or parts
    of one; every window of a document is in exactly one part."""
    parts, used = [], 0
    for document, text in enumerate(texts):
        for at in range(0, max(1, len(text) - SPAN + 1), size - SPAN + 1):
            part = text[at : at + size]
            if len(part) < SPAN:
                continue
            if used + len(part) > size and parts:
                yield _joined(parts)
                parts, used = [], 0
            parts.append((document, at, part))
            used += len(part)
    if parts:
        yield _joined(parts)


def _joined(parts):
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    lengths = np.array([len(p[2]) for p in parts])
    return data, np.array([p[0] for p in parts]), np.array([p[1] for p in parts]), np.cumsum(lengths) - lengths, lengths


def grams_of(hashes: Hashes, n: int) -> np.ndarray:
    """Hashes of all grams of the ``n`` bytes, in order."""
    return mixed((hashes.sums[GRAM : n + 1] - hashes.sums[: n - GRAM + 1]) * hashes.power[: n - GRAM + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def regions(texts: list[bytes], common: np.ndarray):
    """(document, start, stop, anchor, content) arrays of all regions. ``common``: one flag
    for each counter."""
    found = []
    for data, documents, origins, starts, lengths in chunks(texts):
        hashes = Hashes(data)
        gram = grams_of(hashes, len(data))
        late = common[(gram >> np.uint64(42)).astype(np.int64)].astype(np.uint64) << np.uint64(63)
        order = late | ((gram >> np.uint64(21)) << np.uint64(20)) | np.arange(len(gram), dtype=np.uint64)
        anchor = (_least(order, SPAN - GRAM + 1) & _PLACE).astype(np.int64)
        # Windows that lie in one part.
        windows = lengths - SPAN + 1
        part = np.repeat(np.arange(len(starts)), windows)
        window = np.arange(len(part)) + (starts - (np.cumsum(windows) - windows))[part]
        own = anchor[window]
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(own)) - 1
        begin, end = window[first], window[last] + SPAN
        shift = origins[part[first]] - starts[part[first]]
        content = mixed(hashes.of(begin, end) ^ mixed((end - begin).astype(np.uint64)))
        found.append((documents[part[first]], begin + shift, end + shift, gram[own[first]], content))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*found))


def removed_in(shard: list[tuple[int, bytes]]) -> list[tuple[int, int, int]]:
    """(region, start, stop) of what repeats among regions, given in the order of their
    documents as (start in the document, bytes): of equal windows the first one stays."""
    lengths = np.array([len(b) for _, b in shard])
    # Letters of two bytes: numpy sorts these by digits.
    joined = np.zeros(int(lengths.sum()) + len(shard) + 1, np.uint16)
    joined[:-1] = np.frombuffer(b"".join(b + b"\0" for _, b in shard), np.uint8)
    joined[:-1] += 2
    ends = np.cumsum(lengths + 1) - 1
    joined[ends] = 1
    places, common = suffix_order(joined, SPAN)
    # The region of every place; the last place is in none.
    region = np.repeat(np.arange(len(ends) + 1, dtype=np.int32), np.append(lengths + 1, 1))[places]
    starts = ends - lengths
    inside = np.minimum(region, len(ends) - 1)
    whole = (region < len(ends)) & (places + SPAN <= ends[inside])
    linked = common >= SPAN
    # Runs of suffixes that share a window; those that are none of a region break runs anyway.
    run = np.cumsum(~linked)[whole]
    # Regions lie in their order, so places tell which window of a run comes first.
    bits = len(joined).bit_length()
    placed = np.sort(run << bits | places[whole])
    later = placed[1:][placed[1:] >> bits == placed[:-1] >> bits] & ((1 << bits) - 1)
    later.sort()
    region = np.searchsorted(ends, later)
    own = np.array([s for s, _ in shard])[region] + later - starts[region]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (region[1:] != region[:-1]) | (own[1:] > own[:-1] + SPAN)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(own)) - 1
    return [(int(r), int(a), int(b) + SPAN) for r, a, b in zip(region[first], own[first], own[last])] if len(own) else []


def keyed(docs: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``text``: a is the id (the smallest long for null), b tells apart
    different texts of one id, where ids are repeated. Repeated rows are one document."""
    ids = docs.agg(F.count("*").alias("n"), F.count_distinct(F.coalesce("doc_id", F.lit(-(2**63)))).alias("d")).first()
    same = F.lit(0) if ids["n"] == ids["d"] else F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(
        F.coalesce("doc_id", F.lit(-(2**63))).cast("long").alias("a"), same.cast("long").alias("b"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def common_grams(texts: DataFrame) -> np.ndarray:
    """A flag for each of ``COUNTERS`` counters: whether its grams have more places than a
    share ``COMMON`` of the documents. Only an order follows from it, not a result."""

    def counted(rows):
        release_worker()
        held, documents = np.zeros(COUNTERS, np.int32), 0
        for batch in in_parts(rows, DOCUMENTS):
            encoded = [t.encode() for t in batch.column(0).to_pylist()]
            documents += len(encoded)
            for data, *_ in chunks(encoded):
                np.add.at(held, (grams_of(Hashes(data), len(data)) >> np.uint64(42)).astype(np.int64), np.int32(1))
        most = np.flatnonzero(held >= max(8, COMMON * documents + 2 * held.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(most, pa.int64()), pa.array(held[most], pa.int64())], ["counter", "held"])

    many = texts.select("text").mapInArrow(counted, "counter long, held long").groupBy("counter").agg(F.sum("held").alias("held"))
    least = max(8.0, COMMON * texts.count())
    flags = np.zeros(COUNTERS, bool)
    # At most one row a counter.
    flags[[r["counter"] for r in many.filter(F.col("held") >= least).select("counter").toLocalIterator()]] = True
    return flags


def repeated(texts: DataFrame) -> DataFrame:
    """``a``, ``b``, ``start``, ``stop``: bytes to remove, as spans that may overlap."""
    flags = np.packbits(common_grams(texts))
    broadcast = texts.sparkSession.sparkContext.broadcast(flags)
    names = ["a", "b", "start", "stop", "anchor", "content", "copy"]

    def anchored(rows):
        common = np.unpackbits(broadcast.value)[:COUNTERS]
        for batch in rows:
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for at in range(0, batch.num_rows, DOCUMENTS):
                encoded = [t.encode() for t in batch.column(2).slice(at, DOCUMENTS).to_pylist()]
                document, start, stop, anchor, content = regions(encoded, common)
                da, db = a[at : at + DOCUMENTS][document], b[at : at + DOCUMENTS][document]
                # Equal regions meet here already: later ones need no grouping, so they are
                # spread by a key of their own.
                order = np.lexsort((start, db, da, content, anchor))
                anchor, content, da, db = anchor[order], content[order], da[order], db[order]
                start, stop = start[order], stop[order]
                copy = np.zeros(len(order), bool)
                copy[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
                twice = np.zeros(len(order), bool)
                twice[1:] = copy[1:] & (da[1:] == da[:-1]) & (db[1:] == db[:-1]) & (start[1:] == start[:-1])
                anchor[copy] = mixed(da[copy].view(np.uint64) * np.uint64(31) + start[copy].view(np.uint64))
                kept = ~twice
                values = (da, db, start, stop, anchor.view(np.int64), content.view(np.int64), copy)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(v[kept], k) for v, k in zip(values, kinds)], names)

    found = texts.mapInArrow(anchored, "a long, b long, start int, stop int, anchor long, content long, copy boolean")
    group = Window.partitionBy("anchor")
    line = group.orderBy("content", "a", "b", "start")
    place = F.struct("a", "b", "start")
    # The groups of one anchor are read through, never held.
    found = found.withColumn("_same", (F.lag("content").over(line) == F.col("content")) & ~F.lag("copy").over(line) & ~F.col("copy"))
    found = found.withColumn("_twice", F.coalesce(F.lag(place).over(line) == place, F.lit(False)) & F.coalesce("_same", F.lit(False)))
    found = found.withColumn("_later", F.coalesce("_same", F.lit(False)))
    found = found.withColumn("_low", F.min(F.when(~F.col("copy"), F.col("content"))).over(group))
    found = found.withColumn("_high", F.max(F.when(~F.col("copy"), F.col("content"))).over(group))
    found = found.filter("NOT _twice AND (copy OR _later OR _low < _high)")
    found = stored(found.select("a", "b", "start", "stop", "anchor", (F.col("copy") | F.col("_later")).alias("later")), "regions")

    compared = found.filter("NOT later").groupBy("a", "b").agg(F.collect_list(F.struct("anchor", "start", "stop")).alias("regions"))

    def cut(rows):
        for batch in rows:
            for a, b, text, own in zip(*(batch.column(i) for i in range(4))):
                data = text.as_py().encode()
                own = own.values
                anchor, start, stop = (own.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                n = len(anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array([a.as_py()] * n, pa.int64()), pa.array([b.as_py()] * n, pa.int64()), pa.array(start, pa.int32()),
                     pa.array([data[x:y] for x, y in zip(start.tolist(), stop.tolist())], pa.binary())],
                    ["anchor", "a", "b", "start", "bytes"])

    parts = texts.dropDuplicates(["a", "b"]) if not _single(texts) else texts
    parts = parts.join(compared, ["a", "b"]).select("a", "b", "text", "regions")
    parts = parts.mapInArrow(cut, "anchor long, a long, b long, start int, bytes binary")
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sorted_shards(rows):
        """Anchors follow one another; regions are gathered up to ``SHARD`` bytes, or to the
        end of an anchor whose regions are more than that."""
        release_worker()
        shard, size, last = [], 0, None
        for batch in in_parts(rows):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SHARD and row[0] != last:
                    yield spans(shard)
                    shard, size = [], 0
                shard.append(row[1:])
                size += len(row[4])
                last = row[0]
        if shard:
            yield spans(shard)

    def spans(shard):
        shard.sort(key=lambda r: r[:3])
        out = [(*shard[r][:2], x, y) for r, x, y in removed_in([(s, t) for _, _, s, t in shard])]
        columns = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "start", "stop"])

    shards = parts.repartition(width, "anchor").sortWithinPartitions("anchor")
    sorted_out = shards.mapInArrow(sorted_shards, "a long, b long, start int, stop int")
    return found.filter("later").select("a", "b", "start", "stop").unionByName(sorted_out)


def _single(texts: DataFrame) -> bool:
    """Whether ``b`` is the constant that stands for ids that are not repeated."""
    return not texts.filter("b <> 0").limit(1).count()


def with_spans(docs: DataFrame, name: str) -> DataFrame:
    """All rows with a new column ``name``: sorted arrays of (start, stop), null where nothing
    goes."""
    texts = keyed(docs)
    # Spans of one document number less than its bytes.
    spans = stored(repeated(texts), "spans").groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(name))
    own = free_names(docs, name, "a", "b", "left_a", "left_b")[1:]
    spans = spans.withColumnsRenamed({"a": own[0], "b": own[1]})
    single = _single(texts)
    a = F.coalesce("doc_id", F.lit(-(2**63))).cast("long")
    b = F.lit(0).cast("long") if single else F.xxhash64(F.coalesce("text", F.lit("")))
    left = docs.withColumns({own[2]: a, own[3]: b})
    return left.join(spans, (F.col(own[2]) == F.col(own[0])) & (F.col(own[3]) == F.col(own[1])), "left").drop(*own)


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs covered by sorted (start, stop) spans."""
    out: list[list[int]] = []
    for start, stop in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _runs(spans) -> list[tuple[int, int]]:
    if not spans.is_valid:
        return []
    values = spans.values
    return merged(zip(values.field(0).to_pylist(), values.field(1).to_pylist()))


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept_sha256. A null text is empty;
    texts of less than ``SPAN`` bytes stay whole; a null id counts as smaller than all
    others; repeated rows (equal id and text) are one document and get equal results, and
    different texts with one id are told apart, in an order of their own."""

    def cut(rows):
        for batch in rows:
            out = []
            for doc_id, text, spans in zip(*(batch.column(i) for i in range(3))):
                data, at, gone, kept = (text.as_py() or "").encode(), 0, 0, hashlib.sha256()
                runs = _runs(spans)
                for start, stop in runs:
                    kept.update(data[at:start])
                    gone, at = gone + stop - start, stop
                kept.update(data[at:])
                out.append((doc_id.as_py(), len(data), gone, len(runs), kept.hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = with_spans(docs.select("doc_id", "text"), "spans")
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """All rows and columns, with what repeats cut out of ``text`` (null stays null). A text
    stays valid: characters of which only some bytes repeat are kept whole."""

    def cut(rows):
        release_worker()
        for batch in in_parts(rows):
            texts = []
            for text, spans in zip(batch.column(0), batch.column(1)):
                runs = _runs(spans)
                if not runs:
                    texts.append(text.as_py())
                    continue
                data, at, kept = text.as_py().encode(), 0, []
                for start, stop in runs:
                    while start < stop and data[start] & 0xC0 == 0x80:
                        start += 1
                    while stop > start and stop < len(data) and data[stop] & 0xC0 == 0x80:
                        stop -= 1
                    kept.append(data[at:start])
                    at = stop
                texts.append(b"".join([*kept, data[at:]]).decode())
            others = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *others], ["text", *batch.schema.names[2:]])

    others = [c for c in docs.columns if c != "text"]
    (name,) = free_names(docs, "spans")
    rows = with_spans(docs, name).select("text", name, *others)
    schema = ", ".join(f"`{n}` {t}" for n, t in [("text", "string"), *((n, t) for n, t in docs.dtypes if n != "text")])
    return rows.mapInArrow(cut, schema).select(*docs.columns)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 100-byte strings."""
    return digests(table(spark, sf_dir, "documents"))


by_value(__name__)
