"""Operator 6: Jaccard join of word 5-grams by partitions of the universe.

Two sets of sizes a and b with a similarity of at least 3/4 differ in at most (a + b) / 7
elements. Sets are cut into segments by their elements' hashes, in as many segments as
their size band asks for. If H differing elements are spread over H + 1 segments in which
one of the sets has something, one such segment is equal in both. So each set indexes
the contents of segments, by cost:

* elements that very many sets hold are allocated to no segment, as their segments would
  match everywhere; the first H + 1 segments of the others are indexed, one row each;
* a set that has too few such segments is *poor*. Two sets are missed by the above only if
  both are poor, so the poor ones index, among themselves, all segments of all elements and
  what is left of each with one element deleted. An allocation that gives one unit to a
  segment of one element and two to larger ones then finds H differing elements if it has
  H + 1 units;
* sets with fewer units yet index, among themselves, each element.

Sets that share a row are candidates. A sketch of a bit per element, the parity of how many
elements fall on it, differs in as many bits as the sets do in elements at most; pairs whose
sketches differ more than linked sets can are dropped, and the others are compared exactly.
One node stands for all equal sets, and pairs within a known component need no comparison.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import broadcast_if_small, by_value, release_worker, stored, table
from lotwise.llm.components import components, extended

WORDS = 5
#: An element is common if more than this share of the sets hold it.
COMMON = 0.0005
#: Elements that are counted together, and sets remembered, in a task.
BLOCK, SEEN = 2_000_000, 200_000
#: Rows of one or two longs that may be broadcast (about 30 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bits of the largest sketch, and of the short one that nodes carry into large buckets.
SKETCH, SHORT = 1 << 16, 512
#: Nodes of a bucket whose pairs are plainly joined; of a block of a larger bucket; pairs of
#: those that are compared at once.
SMALL, NODES, PAIRS = 4, 4096, 200_000
#: Orders of nodes by which buckets choose the one that others are first compared with.
ORDERS = 8
#: Components that a node is compared with before it is with all others that it meets.
NEAREST = 4
#: Bytes of text whose sets are taken at once, pairs whose sketches are, and bytes of the
#: longest word that is hashed together with others.
CHUNK, COMPARED, LONG = 1 << 19, 2048, 64
#: Letters A-Z lower-cased, every space a blank; the first 0 to 8 bytes of eight.
PLAIN = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some text start, and their 64-bit hashes: of eight bytes at a time
    for all words at once, of the few that have more than ``LONG`` bytes by xxhash."""
    import xxhash

    # There is space at both ends, and eight bytes can be taken from wherever a word has one.
    data = b" " + data.translate(PLAIN) + b" " * 8
    gap = np.frombuffer(data, np.uint8) == 32
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, length = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    h = length.astype(np.uint64)
    at = np.flatnonzero(length <= LONG)
    for offset in range(0, LONG, 8):
        at = at[length[at] > offset] if offset else at
        if not len(at):
            break
        part = eight[starts[at] + offset] & BYTES[np.minimum(length[at] - offset, 8)]
        h[at] = mixed(h[at] * STEP + part)
    for i in np.flatnonzero(length > LONG):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + length[i]])
    return starts - 1, h


def _combined(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    whole = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        whole *= STEP
        whole += h[i : len(h) - width + 1 + i]
        whole = mixed(whole)
    return whole


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles; a text of fewer words is one."""
    texts = [text or b"" for text in texts]
    starts, h = _word_hashes(b" ".join(texts))
    ends = np.cumsum([len(text) + 1 for text in texts])
    first = np.append(0, np.searchsorted(starts, ends)).tolist()
    whole = _combined(h, words) if len(h) >= words else np.zeros(0, np.uint64)
    found = []
    for at, end in zip(first, first[1:]):
        if end - at >= words:
            own = whole[at : end - words + 1]
            own.sort()
            fresh = own[1:] != own[:-1]
            own = own.copy() if fresh.all() else own[np.append(True, fresh)]
        else:
            own = _combined(h[at:end], end - at) if end > at else np.zeros(0, np.uint64)
        found.append(own)
    return found


def sets_in(column: pa.Array, words: int = WORDS, size: int = CHUNK):
    """``shingle_sets`` of a column of texts, for runs of rows that have ``size`` bytes or so."""
    texts, held = [], 0
    for text in column.cast(pa.binary()).to_pylist():
        texts.append(text)
        held += len(text or b"") + 1
        if held >= size:
            yield shingle_sets(texts, words)
            texts, held = [], 0
    if texts:
        yield shingle_sets(texts, words)


def node_of(elements: np.ndarray) -> int | None:
    """Identifier of a set; of the empty one, none."""
    import xxhash

    return xxhash.xxh3_64_intdigest(elements.tobytes()) - 2**63 if len(elements) else None


def sketch_of(elements: np.ndarray, bits: int | None = None) -> bytes:
    """Parities of the numbers of elements by their last bits; if not said, as many bits as
    the first power of two from their number on, 64 at least."""
    if bits is None:
        bits = min(SKETCH, max(64, 1 << (len(elements) - 1).bit_length())) if len(elements) else 64
    return np.packbits(np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def differing(left: bytes, right: bytes) -> int:
    """Bits that differ, when the longer sketch is folded to the length of the other."""
    small, large = sorted((np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)), key=len)
    folded = np.bitwise_xor.reduce(large.reshape(-1, len(small)), axis=0)
    return int(np.bitwise_count(small ^ folded).sum())


def nearby(left: list[bytes], right: list[bytes], most: np.ndarray) -> np.ndarray:
    """Whether each two sketches are ``differing`` in ``most`` bits or fewer; those of the same
    lengths are compared at once."""
    kept = np.zeros(len(left), bool)
    lengths = np.array([(len(x), len(y)) for x, y in zip(left, right)], np.int64).reshape(-1, 2)
    for a, b in np.unique(lengths, axis=0).tolist():
        same = np.flatnonzero((lengths == (a, b)).all(axis=1))
        for start in range(0, len(same), COMPARED):
            at = same[start : start + COMPARED]
            x, y = (np.frombuffer(b"".join([side[i] for i in at.tolist()]), np.uint64) for side in (left, right))
            small = min(a, b) // 8
            x, y = (np.bitwise_xor.reduce(side.reshape(len(at), -1, small), axis=1) for side in (x, y))
            kept[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= most[at]
    return kept


def bands(sizes: np.ndarray):
    """For both partitions that sets of these sizes may take part in, that of their own sizes
    and that of the next, where they may be the smaller one: whether they do, band, segments
    and most differing elements."""
    most = sizes * 4 // 3
    length = np.frexp(sizes.astype(np.float64))[1].astype(np.int64)
    for band in (length - 1, length):
        low, high = np.left_shift(1, band), np.left_shift(2, band) - 1
        yield most >= low, band, high * 2 // 5 + 4, (sizes + np.minimum(high, most)) // 7


class Common:
    """The common elements, sorted, with a table by their first bits that few others are in."""

    def __init__(self, elements: np.ndarray):
        self.elements = elements
        bits = min(24, 5 + max(1, len(elements)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[elements >> self.shift] = True

    def rare(self, elements: np.ndarray) -> np.ndarray:
        """Which of the elements are not common."""
        found = ~self.table[elements >> self.shift]
        maybe = np.flatnonzero(~found)
        if len(maybe):
            place = np.searchsorted(self.elements, elements[maybe])
            found[maybe] = self.elements[np.minimum(place, len(self.elements) - 1)] != elements[maybe]
        return found


def signatures(elements: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The rows that a set indexes. ``common`` is sorted."""
    return signature_rows([elements], Common(common))[0] if len(elements) else np.zeros(0, np.uint64)


def signature_rows(sets: list[np.ndarray], common: Common) -> tuple[np.ndarray, np.ndarray]:
    """The rows that sets index, none of them empty, and the number of the set for each."""
    sizes = np.array([len(elements) for elements in sets], np.int64)
    rare, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    kept = common.rare(rare)
    rare, owner = rare[kept], owner[kept]
    hashed = mixed(rare)
    found, owners = [], []
    for takes, band, segments, most in bands(sizes):
        salt = (band << 2).astype(np.uint64)
        number = ((rare >> np.uint64(32)) * segments.astype(np.uint64)[owner]) >> np.uint64(32)
        fresh = np.ones(len(number), bool)
        fresh[1:] = (number[1:] != number[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(fresh)
        content = np.add.reduceat(hashed, starts) if len(starts) else np.zeros(0, np.uint64)
        number, whose = number[starts], owner[starts]
        held = np.bincount(whose, minlength=len(sets))
        place = np.arange(len(whose)) - (np.cumsum(held) - held)[whose]
        taken = takes[whose] & (place <= most[whose])
        number, content, whose = number[taken], content[taken], whose[taken]
        found.append(_rows(number, content, segments.astype(np.uint64)[whose], salt[whose]))
        owners.append(whose)
        for i in np.flatnonzero(takes & (held <= most)).tolist():
            found.append(_poor(sets[i], int(segments[i]), int(most[i]), salt[i : i + 1]))
            owners.append(np.full(len(found[-1]), i))
    return np.concatenate(found), np.concatenate(owners)


def _poor(elements: np.ndarray, segments: int, most: int, salt: np.ndarray) -> np.ndarray:
    """The rows that a poor set indexes besides."""
    at, content, sizes, owner = _segments(elements, segments)
    left = content[owner] - mixed(elements)
    several = sizes[owner] > 1
    found = [_rows(at, content, segments, salt + np.uint64(1))]
    found.append(_rows(at[owner][several], left[several], segments, salt + np.uint64(1)))
    if 2 * np.count_nonzero(sizes > 1) + np.count_nonzero(sizes == 1) <= most:
        found.append(mixed(elements + mixed(salt + np.uint64(2))))
    return np.unique(np.concatenate(found))


def _segments(elements: np.ndarray, segments: int):
    """Numbers, contents (sums of mixed hashes) and sizes of the segments that are not empty,
    and which of them each element is in."""
    number = ((elements >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    fresh = np.ones(len(number), bool)
    fresh[1:] = number[1:] != number[:-1]
    starts = np.flatnonzero(fresh)
    content = np.add.reduceat(mixed(elements), starts)
    return number[starts], content, np.diff(np.append(starts, len(number))), np.cumsum(fresh) - 1


def _rows(number: np.ndarray, content: np.ndarray, segments: int | np.ndarray, salt: np.ndarray) -> np.ndarray:
    return mixed(content ^ mixed(number + mixed(salt * STEP + np.uint64(segments))))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def mark(text: str = "text") -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark")


def sets_of(docs: DataFrame, words: int = WORDS, share: float = COMMON) -> DataFrame:
    """Per row: doc_id, n_shingles, node, sketch, short (sketch) and mark. Besides, rows with ``element`` and ``held`` (and
    no ``row``): elements that many sets of a block of rows hold. An element that is common
    in all is so in some block, so adding the blocks' counts finds it."""

    def batches(rows):
        release_worker()
        seen, gathered, size = set(), [], 0

        def counted():
            element, held = np.unique(np.concatenate(gathered), return_counts=True)
            many = held >= max(4, share * len(gathered))
            n = int(many.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                 pa.array([False] * n, pa.bool_()), _longs(element[many]), pa.array(held[many], pa.int64()), pa.nulls(n, pa.int64())], names)

        names = ["doc_id", "n_shingles", "node", "sketch", "short", "row", "element", "held", "mark"]
        for batch in rows:
            counts, nodes, sketches, shorts = [], [], [], []
            for own in chain.from_iterable(sets_in(batch.column(1), words)):
                node = node_of(own)
                counts.append(len(own))
                nodes.append(node)
                sketches.append(sketch_of(own))
                shorts.append(sketch_of(own, SHORT))
                if node is not None and node not in seen:
                    seen.add(node)
                    gathered.append(own)
                    size += len(own)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.array(shorts, pa.binary()), pa.array([True] * n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), batch.column(2)], names)
            if size > BLOCK or len(seen) > SEEN:
                yield counted()
                seen, gathered, size = set(), [], 0
        if gathered:
            yield counted()

    schema = "doc_id long, n_shingles long, node long, sketch binary, short binary, row boolean, element long, held long, mark long"
    return docs.select("doc_id", "text", mark()).mapInArrow(batches, schema)


def indexed(docs: DataFrame, common: np.ndarray, words: int = WORDS) -> DataFrame:
    """``sig`` and ``node``: the rows that every set indexes, once a task for equal sets."""
    broadcast = docs.sparkSession.sparkContext.broadcast(common)

    def batches(rows):
        known, seen = Common(broadcast.value), set()
        for batch in rows:
            for sets in sets_in(batch.column(0), words):
                fresh = {}
                for own in sets:
                    node = node_of(own)
                    if node is not None and node not in seen:
                        fresh[node] = own
                        seen.add(node)
                if len(seen) > SEEN:
                    seen.clear()
                if fresh:
                    sigs, owner = signature_rows(list(fresh.values()), known)
                    yield pa.RecordBatch.from_arrays([_longs(sigs), pa.array(np.array(list(fresh), np.int64)[owner])], ["sig", "node"])

    return docs.select("text").mapInArrow(batches, "sig long, node long")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Those pairs (a, b of ``node``) whose sets have a similarity of 75 in 100 or more."""
    def side(name: str) -> DataFrame:
        kept = {"node": name, "doc_id": f"doc_{name}", "n_shingles": f"n_{name}", "sketch": f"sketch_{name}"}
        return nodes.select(*(F.col(k).alias(v) for k, v in kept.items()))

    def near(rows):
        for batch in rows:
            a, b = (batch.column(i).to_pylist() for i in (4, 5))
            n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            yield batch.select([0, 1, 6, 7]).filter(pa.array(nearby(a, b, (n_a + n_b) // 7), pa.bool_()))

    possible = pairs.join(side("a"), "a").join(side("b"), "b").filter("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")
    possible = possible.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "doc_a", "doc_b")
    possible = stored(possible.mapInArrow(near, "a long, b long, doc_a long, doc_b long"), "candidates")
    ids = possible.select(F.col("doc_a").alias("doc_id")).unionByName(possible.select(F.col("doc_b").alias("doc_id"))).distinct()
    ids = broadcast_if_small(ids, BROADCAST_ROWS)

    def batches(rows):
        for batch in rows:
            for own in sets_in(batch.column(0), words):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], ["node", "elements"]
                )

    # Rows of one id may be repeated or differ: the node says which set it is, and a link
    # that is found twice is one.
    kinds = "node long, elements binary"
    sets = docs.join(ids, "doc_id", "left_semi").select("text").mapInArrow(batches, kinds)
    # Sets that only rows without id hold are chosen by node, once each.
    sides = [possible.filter(f"doc_{n} IS NULL").select(F.col(n).alias("node")) for n in "ab"]
    unnamed = sides[0].unionByName(sides[1]).distinct()
    if not unnamed.isEmpty():
        rest = docs.filter("doc_id IS NULL").select("text").mapInArrow(batches, kinds)
        rest = rest.join(broadcast_if_small(unnamed, BROADCAST_ROWS), "node", "left_semi")
        sets = sets.unionByName(rest.dropDuplicates(["node"]))
    sets = stored(sets, "sets")
    both = possible.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("elements").alias("left")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("right")), "b").select("a", "b", "left", "right")

    def compared(rows):
        for batch in rows:
            linked = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * shared >= 75 * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(compared, "a long, b long")


def crowded(rows: DataFrame, nodes: DataFrame, best: bool = False) -> DataFrame:
    """Pairs (x, y) of nodes that share a row, are not known to be connected (``label``) and
    may be linked by their sizes and short sketches, x the smaller one. With ``best``, only
    the nearest y of each ``label`` for each x. ``members`` counts the nodes of a row.
    Those of one row come together in a task, which compares them and gives on only the
    pairs that pass. A row of very many nodes is cut into blocks, and every two of these
    come together, so that a task never holds more than two blocks."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    carried = rows.select("sig", "node", "label", "members").join(nodes.select("node", "n_shingles", "short"), "node")
    blocks = F.ceil(F.col("members") / NODES).cast("int")
    own, other = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    carried = carried.withColumn("own", own).withColumn("other", other)
    # The two blocks make a place of their own in the order: a hash of row and blocks.
    place = F.when(blocks == 1, F.col("sig")).otherwise(F.xxhash64("sig", F.least("own", "other"), F.greatest("own", "other")))
    carried = carried.select(place.alias("sig"), "node", "label", "n_shingles", "short")
    carried = carried.repartition(width, "sig").sortWithinPartitions("sig")

    def pairs(batches):
        held = None
        for batch in batches:
            sig, node, label, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            short = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            columns = [sig, node, label, size, short]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            # The last row's nodes may go on in the next batch.
            changes = np.flatnonzero(columns[0][1:] != columns[0][:-1])
            end = int(changes[-1]) + 1 if len(changes) else 0
            held = [c[end:] for c in columns]
            yield from found([c[:end] for c in columns])
        if held is not None:
            yield from found(held)

    def found(columns):
        sig, node, label, size, short = columns
        n = len(sig)
        if n < 2:
            return
        fresh = np.append(True, sig[1:] != sig[:-1])
        stop = np.append(np.flatnonzero(fresh)[1:], n)[np.cumsum(fresh) - 1]
        # Every node with those after it in its row.
        after = stop - np.arange(n) - 1
        at, offset = 0, 0
        while at < n:
            left, right = [], []
            room = PAIRS
            while at < n and room > 0:
                taken = min(room, int(after[at]) - offset)
                left.append(np.full(taken, at))
                right.append(np.arange(at + 1 + offset, at + 1 + offset + taken))
                room, offset = room - taken, offset + taken
                if offset >= after[at]:
                    at, offset = at + 1, 0
            x, y = np.concatenate(left), np.concatenate(right)
            possible = (label[x] != label[y]) & (4 * np.minimum(size[x], size[y]) >= 3 * np.maximum(size[x], size[y]))
            x, y = x[possible], y[possible]
            far = np.bitwise_count(short[x] ^ short[y]).sum(axis=1, dtype=np.int64)
            near = far <= (size[x] + size[y]) // 7
            x, y, far = x[near], y[near], far[near] / (size[x[near]] + size[y[near]])
            if best:
                x, y, far = np.append(x, y), np.append(y, x), np.append(far, far)
                order = np.lexsort((far, label[y], x))
                x, y, far = x[order], y[order], far[order]
                kept = np.append(True, (x[1:] != x[:-1]) | (label[y[1:]] != label[y[:-1]]))[: len(x)]
            else:
                turned = node[x] > node[y]
                x, y = np.where(turned, y, x), np.where(turned, x, y)
                kept = slice(None)
            x, y, far = x[kept], y[kept], far[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[x]), pa.array(node[y]), pa.array(label[y]), pa.array(far, pa.float64())], ["x", "y", "label", "distance"]
            )

    return carried.mapInArrow(pairs, "x long, y long, label long, distance double")


def near_duplicates(docs: DataFrame, words: int = WORDS, marked: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, and its ``mark`` if asked for. Null and empty texts have no
    shingles and are linked with nothing; repeated rows have equal sets and are linked. A
    component without any id has a null one. Elements are 64-bit hashes of the words."""
    docs = docs.select("doc_id", "text")
    found = stored(sets_of(docs, words), "shingles")
    rows = found.filter("row").select("doc_id", "n_shingles", "node", "mark")
    # Copies are aggregated before the shuffle.
    nodes = stored(found.filter("row AND node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"), F.max("short").alias("short")), "nodes")
    least = COMMON * nodes.count()
    # At most (elements of all sets / COMMON / sets) are common: some hundred per shingle of a
    # mean text, however many there are.
    held = found.filter("NOT row").groupBy("element").agg(F.sum("held").alias("held")).filter(F.col("held") >= max(4.0, least))
    common = np.sort(np.array([r["element"] for r in held.select("element").toLocalIterator()], np.int64).view(np.uint64))

    line = Window.partitionBy("sig")
    buckets = indexed(docs, common, words).withColumn("first", F.min("node").over(line)).withColumn("last", F.max("node").over(line))
    buckets = buckets.withColumn("members", F.count("*").over(line)).filter("first < last")
    turn = F.pmod("sig", F.lit(ORDERS))
    head = F.min(F.struct(F.xxhash64("node", turn).alias("place"), "node")).over(line)
    buckets = stored(buckets.withColumn("head", head).select("sig", "node", "head", "members"), "buckets")
    # First each node with the heads of its buckets, one for each order: linear in the nodes.
    heads = buckets.groupBy("node", turn.alias("turn")).agg(F.min("head")["node"].alias("head")).filter("node <> head")
    tried = heads.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    tried = stored(tried, "tried")
    labels = components(verified(tried, nodes, docs, words))

    def named(labels: DataFrame) -> DataFrame:
        rows = buckets.select("sig", "node", "members").join(broadcast_if_small(labels, BROADCAST_ROWS), "node", "left")
        return rows.withColumn("label", F.coalesce("label", "node"))

    # Then each node with the nearest one, by sketches, of each other component that it meets:
    # first with the few nearest of these, as most of many near copies are connected by them,
    # and after that only of the components that are left.
    met = crowded(named(labels).filter(F.col("members") > SMALL), nodes, best=True)
    met = met.groupBy("x", "label").agg(F.min(F.struct("distance", "y")).alias("near")).select("x", "near.*")
    met = stored(met, "met")

    def unordered(rows: DataFrame) -> DataFrame:
        return rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    place = F.row_number().over(Window.partitionBy("x").orderBy("distance", "y"))
    nearest = unordered(met.withColumn("place", place).filter(F.col("place") <= NEAREST))
    tried = stored(tried.unionByName(nearest.join(tried, ["a", "b"], "left_anti").withColumn("fresh", F.lit(True)), True), "tried")
    fresh, tried = tried.filter("fresh").drop("fresh"), tried.drop("fresh")
    labels = extended(labels, stored(verified(fresh, nodes, docs, words), "links"))
    for side in "xy":
        own = broadcast_if_small(labels, BROADCAST_ROWS).select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        met = met.join(own, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    best = met.filter("label_x <> label_y").groupBy("x", "label_y").agg(F.min(F.struct("distance", "y"))["y"].alias("y"))
    best = stored(unordered(best).join(tried, ["a", "b"], "left_anti"), "best")
    labels = extended(labels, stored(verified(best, nodes, docs, words), "links"))
    # Then all pairs of nodes that share a row and are still not known to be connected.
    rows_left = named(labels)
    few = rows_left.filter(F.col("members") <= SMALL)
    a, b = few.alias("a"), few.alias("b")
    apart = (F.col("a.sig") == F.col("b.sig")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label"))
    rest = a.join(b, apart).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    rest = rest.unionByName(crowded(rows_left.filter(F.col("members") > SMALL), nodes).select(F.col("x").alias("a"), F.col("y").alias("b")))
    rest = rest.distinct().join(tried.unionByName(best), ["a", "b"], "left_anti")
    labels = extended(labels, stored(verified(rest, nodes, docs, words), "links"))

    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component"))
    named = named.select("node", "label").join(smallest, "label").select("node", "component")
    # A node of very many copies is a skewed key, which the adaptive planner splits.
    return rows.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), *(["mark"] if marked else [])
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * held >= 75 * (x.n + y.n - held)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT words.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(words.doc_id, coalesce(low, words.doc_id)) AS component_id
FROM words LEFT JOIN sizes ON sizes.doc_id = words.doc_id LEFT JOIN lowest ON a = words.doc_id
"""

by_value(__name__)
