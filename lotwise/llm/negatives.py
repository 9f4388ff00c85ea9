"""Operator 11: hard negatives, filtered by one-bit codes.

A vector is rotated and its signs are stored as bits, with the alignment of the vector and
that unit code; what the code leaves is rotated and coded again, level by level. An
anchor's product with a code is a popcount over bit planes of the rotated anchor, so
alignments times popcounts estimate the product of the vectors, and by Cauchy and Schwarz
the estimate is off by no more than the lengths of what is left. Candidates whose interval
cannot reach a list leave after each level, and those that stay are scored with integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, stored, table
from lotwise.llm.vectors import smallest_first

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LEAST, MOST = 30, 90
#: Codes per vector, bit planes of an anchor.
LEVELS, PLANES = 6, 8
#: Anchors that are broadcast at once: each wave of them reads all rows where they lie.
WAVE = 16_384


def rotation(size: int, level: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng((size, level)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def coded(vectors: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words), alignments (rows, levels) and the lengths of what each
    level leaves (rows, levels)."""
    n, size = vectors.shape
    left, codes = vectors.astype(np.float64), []
    aligned, lengths = np.zeros((n, levels)), np.zeros((n, levels))
    for level in range(levels):
        turn = rotation(size, level)
        turned = left @ turn.T
        signs = turned >= 0
        unit = np.where(signs, 1.0, -1.0) / np.sqrt(size)
        aligned[:, level] = (turned * unit).sum(1)
        left = (turned - aligned[:, level, None] * unit) @ turn
        lengths[:, level] = np.sqrt((left * left).sum(1))
        codes.append(_words(signs))
    return np.stack(codes, 1), aligned, lengths


class Asked:
    """Anchors, prepared to be multiplied with codes."""

    def __init__(self, anchors: np.ndarray, levels: int = LEVELS):
        n, size = anchors.shape
        self.size, self.levels = size, levels
        self.lengths = np.sqrt((anchors.astype(np.float64) ** 2).sum(1))
        self.planes, self.low, self.step, self.total, self.off = [], [], [], [], []
        for level in range(levels):
            turned = anchors.astype(np.float64) @ rotation(size, level).T
            low = turned.min(1)
            step = (turned.max(1) - low) / (2**PLANES - 1)
            grid = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1.0)[:, None]).astype(np.int64)
            near = low[:, None] + step[:, None] * grid
            self.planes.append(np.stack([_words((grid >> b) & 1 == 1) for b in range(PLANES)], 1))
            self.low.append(low)
            self.step.append(step)
            self.total.append(near.sum(1))
            self.off.append(np.sqrt(((turned - near) ** 2).sum(1)))

    def product(self, level: int, anchor: int, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """The anchor's product with unit codes (rows of words); wrong by ``off`` at most."""
        hit = np.zeros(len(codes), np.int64)
        for bit in range(PLANES):
            common = np.bitwise_count(codes & self.planes[level][anchor, bit])
            hit += (common[:, 0] if common.shape[1] == 1 else common.sum(1)).astype(np.int64) << bit
        above = self.low[level][anchor] * ones + self.step[level][anchor] * hit
        return (2 * above - self.total[level][anchor]) / np.sqrt(self.size)


class Block:
    """Candidates, by ascending id, with their codes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, codes: np.ndarray, aligned: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.vectors, self.codes, self.aligned, self.lengths = ids, labels, vectors, codes, aligned, lengths
        self.ones = np.bitwise_count(codes).sum(2, dtype=np.int64)
        #: What float arithmetic may add to an error, for an anchor of length 1.
        self.slack = 1e-9 * np.sqrt((vectors * vectors).sum(1))

    def left(self, asked: Asked, anchor: int, places: np.ndarray, wanted) -> np.ndarray:
        """Those of the places that ``wanted`` cannot rule out. It is called after each level
        with lower and upper bounds of the products and says which stay."""
        known = wrong = np.zeros(len(places))
        for level in range(asked.levels):
            unit = asked.product(level, anchor, self.codes[places, level], self.ones[places, level])
            off, own = asked.off[level][anchor], self.aligned[places, level]
            known = known + own * unit
            wrong = wrong + own * off
            # What is left stands at right angles to the code: only that part of the anchor counts.
            across = np.maximum(0, asked.lengths[anchor] ** 2 - np.maximum(0, np.abs(unit) - off) ** 2)
            width = wrong + self.lengths[places, level] * np.sqrt(across) + self.slack[places] * asked.lengths[anchor] + 1e-6
            low, high = known - width, known + width
            sure = np.isfinite(low) & np.isfinite(high)
            stay = wanted(np.where(sure, low, -np.inf), np.where(sure, high, np.inf))
            places, known, wrong = places[stay], known[stay], wrong[stay]
        return places

    def scored(self, places: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Integer products; as Python integers where 62 bits may not hold them."""
        rows = self.vectors[places]
        if len(rows) and np.abs(rows).max() * np.abs(vector).max() * len(vector) >= 2.0**62:
            whole = [int(v) for v in vector]
            made = np.empty(len(rows), object)
            made[:] = [sum(int(a) * b for a, b in zip(row, whole)) for row in rows]
            return made
        return rows.astype(np.int64) @ vector.astype(np.int64)


def _kth(bounds: np.ndarray, k: int) -> float:
    return np.partition(bounds, len(bounds) - k)[len(bounds) - k] if len(bounds) >= k else -np.inf


class Best:
    """The ``k`` best (score, id) of what has been offered."""

    def __init__(self, k: int):
        self.k, self.held = k, []

    def least(self) -> float:
        """A score below which nothing is taken any more."""
        return float(self.held[-1][0]) * (1 - 1e-9 * np.sign(self.held[-1][0])) if len(self.held) == self.k else -np.inf

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        at = smallest_first(scores, ids, self.k) if scores.dtype != object else range(len(ids))
        new = [(int(scores[p]), int(ids[p])) for p in at]
        if new:
            self.held = sorted(self.held + new, key=lambda x: (-x[0], x[1]))[: self.k]


def offer_same(block: Block, asked: Asked, anchor: int, own: int, label, vector: np.ndarray, best: Best) -> None:
    """Offer the block's candidates of the anchor's label, but itself."""
    places = np.flatnonzero((block.labels == label) & (block.ids != own))
    places = block.left(asked, anchor, places, lambda low, high: high >= max(best.least(), _kth(low, best.k)))
    best.offer(block.ids[places], block.scored(places, vector))


def offer_bands(block: Block, asked: Asked, anchor: int, label, vector: np.ndarray, bands: list[tuple[int, int]], best: list[Best]) -> None:
    """Offer the candidates of other labels to the bands (smallest and largest score, in
    hundredths) that their scores are in."""
    near = [(a / 100 - 1e-9 * abs(a) - 1, b / 100 + 1e-9 * abs(b) + 1, b / 100 - 1e-9 * abs(b) - 1, x) for (a, b), x in zip(bands, best) if a <= b]

    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), bool)
        for least, most, inside, x in near:
            # k candidates that are surely in the band rule out what is surely below them.
            surely = low[(low >= least + 2) & (high <= inside)]
            stay |= (high >= max(least, x.least(), _kth(surely, x.k))) & (low <= most)
        return stay

    places = block.left(asked, anchor, np.flatnonzero(block.labels != label), wanted)
    scores, ids = block.scored(places, vector), block.ids[places]
    if len(scores) and scores.dtype != object and np.abs(scores).max() >= 2**55:
        scores = scores.astype(object)
    for (a, b), x in zip(bands, best):
        fits = np.flatnonzero(((scores * 100 >= a) & (scores * 100 <= b)).astype(bool))
        x.offer(ids[fits], scores[fits])


_CODED = "vec_id long, label long, vector array<double>, codes binary, aligned binary, lengths binary"


def with_codes(rows: DataFrame) -> DataFrame:
    """``vector`` (whole numbers as doubles) and its codes, for rows of vec_id, label and embedding."""

    def batches(found):
        for batch in found:
            sizes = np.asarray(batch.column(2).value_lengths())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                vectors = np.floor(part.column(2).flatten().to_numpy().astype(np.float64).reshape(-1, size) * SCALE)
                columns = [[row.tobytes() for row in x] for x in coded(vectors)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(vectors), pa.list_(pa.float64())), *(pa.array(c, pa.binary()) for c in columns)],
                    ["vec_id", "label", "vector", "codes", "aligned", "lengths"],
                )

    return rows.mapInArrow(batches, _CODED)


def _blocks(batch: pa.RecordBatch):
    """A block for each length of vectors in a batch of coded rows."""
    sizes = np.asarray(batch.column(2).value_lengths())
    for size in np.unique(sizes):
        part = pa.Table.from_batches([batch]).filter(pa.array(sizes == size)).sort_by("vec_id")
        n, blob = len(part), lambda c, kind: np.frombuffer(b"".join(part[c].to_pylist()), kind)  # noqa: B023
        yield int(size), Block(
            part["vec_id"].to_numpy(), part["label"].to_numpy(), part["vector"].combine_chunks().flatten().to_numpy().reshape(n, size),
            blob("codes", np.uint64).reshape(n, LEVELS, -1), blob("aligned", float).reshape(n, LEVELS), blob("lengths", float).reshape(n, LEVELS),
        )


def _scanned(rows: DataFrame, anchors: list[tuple], offers, lists, schema: str) -> DataFrame:
    """All rows of coded vectors against a wave of anchors (id, label, vector, ...): each task
    keeps the lists that ``lists(anchor)`` makes and returns what is in them at its end."""

    def batches(found):
        held = {}
        by_size = {}
        for a in anchors:
            by_size.setdefault(len(a[2]), []).append(a)
        asked = {}
        for batch in found:
            for size, block in _blocks(batch):
                if size not in by_size:
                    continue
                if size not in asked:
                    asked[size] = Asked(np.array([a[2] for a in by_size[size]]))
                for place, anchor in enumerate(by_size[size]):
                    if anchor[0] not in held:
                        held[anchor[0]] = lists(anchor)
                    offers(block, asked[size], place, anchor, held[anchor[0]])
        out = [(a, p, v, s) for a, kept in held.items() for p, x in kept for s, v in x.held]
        for s in out:
            if abs(s[3]) >= 2**63:
                raise ValueError(f"the score of {s[0]} and {s[2]} needs more than 64 bits")
        a, p, v, s = zip(*out) if out else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, p, v, s)], ["anchor_id", "positive_id", "vec_id", "score"])

    return rows.mapInArrow(batches, schema)


def taking_part(vectors: DataFrame, key: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """vec_id, label and embedding of the rows that take part: no null id, label, vector or
    component, none that is infinite or not a number, at least one component. A repeated id
    counts once, with the smallest of its vectors, then labels."""
    fine = f"size({embedding}) > 0 AND forall({embedding}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    rows = vectors.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.expr(f"coalesce({fine}, false)"))
    one = rows.groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(F.struct(F.col(embedding).alias("e"), F.col(label).cast("long").alias("l"))).alias("m"))
    return one.select("vec_id", F.col("m.l").alias("label"), F.col("m.e").alias("embedding"))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each
    anchor (``anchor`` chooses among ids) and each of its ``positives`` best rows of the same
    label, the ``negatives`` best rows of another label whose score is ``LEAST`` to ``MOST``
    hundredths of the positive's. Scores are integer products of floor(SCALE * x); ties go to
    the smaller id.

    Takes ``vec_id``, ``label`` and ``embedding``; other columns are not read. For rows that
    take no part and repeated ids see ``taking_part``. Vectors of different lengths have no
    product. Equal vectors tie. No rows, anchors, positives or rows in a band: no rows. A
    score of over 64 bits that would be listed is an error.

    Rows stay where they are: ``WAVE`` anchors at a time, a bounded number, pass through the
    driver to all tasks. A task returns what its own lists hold, which a window merges."""
    rows = taking_part(vectors)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(with_codes(rows).repartition(parts, "vec_id"), "coded")
    asking = rows.filter(anchor).select("vec_id", "label", "vector")
    waves = max(1, -(-asking.count() // WAVE))
    schema = "anchor_id long, positive_id long, vec_id long, score long"
    done = None
    for wave in range(waves):
        chosen = asking.filter(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave)
        anchors = [(r[0], r[1], np.array(r[2])) for r in chosen.collect()]

        def same(block, asked, place, a, kept):
            offer_same(block, asked, place, a[0], a[1], a[2], kept[0][1])

        def merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
            line = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
            return found.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= k)

        near = merged(_scanned(rows, anchors, same, lambda a: [(None, Best(positives))], schema), ["anchor_id"], positives)
        known = {}
        # At most WAVE times ``positives`` rows.
        for r in near.select("anchor_id", "vec_id", "score").collect():
            known.setdefault(r[0], []).append((r[1], r[2]))
        banded = [(*a, sorted(known[a[0]])) for a in anchors if a[0] in known]

        def other(block, asked, place, a, kept):
            offer_bands(block, asked, place, a[1], a[2], [(LEAST * s, MOST * s) for _, s in a[3]], [x for _, x in kept])

        found = _scanned(rows, banded, other, lambda a: [(p, Best(negatives)) for p, _ in a[3]], schema)
        listed = [(a[0], p, s) for a in banded for p, s in a[3]]
        scores = rows.sparkSession.createDataFrame(listed, "anchor_id long, positive_id long, positive_score long")
        best = merged(found, ["anchor_id", "positive_id"], negatives).join(F.broadcast(scores), ["anchor_id", "positive_id"])
        best = best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        if waves > 1:
            best = stored(best, "negatives")
        done = best if done is None else done.unionByName(best)
    return done


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the label after its own."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY embedding, label) AS n FROM fine) WHERE n = 1),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(generate_series(1, len(a.w)), lambda i: a.w[i] * c.w[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.w) = len(c.w)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
r AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS n
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE n <= 10
"""

by_value(__name__)
