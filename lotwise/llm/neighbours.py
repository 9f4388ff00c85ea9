"""Operator 3: approximate nearest neighbours by shifted Hilbert curves.

Each curve orders the vectors by the Hilbert index of a random projection of their
directions, shifted by a random offset. Its keys are cut into ranges of equally many rows,
fewer where many rows have one key; a query looks at its own range and at those on either
side, in every curve. What it finds is ranked again by the exact cosine and merged. Vectors
of a length that too few have for such ranges are all one range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, stored, table
from lotwise.llm.hilbert import indices
from lotwise.llm.vectors import matrix, smallest_first, usable

#: Curves, projected dimensions and bits of each (dimensions * bits < 64).
CURVES, DIMENSIONS, BITS = 16, 8, 7
#: Ranges of a curve; a query sees three of them. Few are needed where neighbours are hardly
#: nearer than other rows, as in the given vectors; structured ones can do with many more.
RANGES = 24
#: Rows of a range that one task ranks, and queries that it ranks them for.
BLOCK, QUERIES = 4096, 1024
SEED = 20


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors. Scaling by powers of two first keeps tiny and huge components exact."""
    power = np.frexp(np.abs(vectors).max(axis=1))[1] if len(vectors) else np.zeros(0, int)
    scaled = np.ldexp(vectors, -power[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def curve_keys(vectors: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """One column of keys per curve. Projections depend on the number of components only."""
    size = vectors.shape[1]
    rng = np.random.default_rng([seed, size])
    unit, keys = directions(vectors), []
    for _ in range(curves):
        axes = np.linalg.qr(rng.normal(size=(size, size)))[0][:, : min(dimensions, size)]
        # Components of a random direction have a deviation of about 1 / sqrt(size).
        place = (unit @ axes) * np.sqrt(size) / 8 + 0.5 + rng.uniform(-0.06, 0.06, axes.shape[1])
        keys.append(indices(np.clip(place * (1 << bits), 0, (1 << bits) - 1).astype(np.int64), bits))
    return np.stack(keys, axis=1)


def ranges_of(ends: np.ndarray, least: int, n: int, k: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ends of the ranges of ``n`` keys, and into how many parts each range is cut.

    ``ends`` are the keys at every 1/``ranges`` of the rows. Every range begins with a key that
    occurs, so none is empty. With more than k rows to 1/``ranges`` a range and those beside it
    hold at least k + 1 rows; fewer rows in all are left in one range."""
    if n <= ranges * k:
        return np.zeros(0, np.int64), np.array([max(1, -(-n // BLOCK))])
    at, repeats = np.unique(ends[ends > least], return_counts=True)
    shares = np.concatenate([[len(ends) - repeats.sum() + 1], repeats])
    return at, np.maximum(1, -(-n * shares // (ranges * BLOCK)))


def nearest(
    vectors: DataFrame, query: Column, k: int = 5, curves: int = CURVES, ranges: int = RANGES,
    dimensions: int = DIMENSIONS, bits: int = BITS, seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id and score (cosine in double precision) of the k nearest found
    for each id that ``query`` chooses; a query is no candidate of its own, and one with
    fewer candidates gets all of them. Ties go to the smaller id.

    Every row is indexed. Equal vectors have equal keys, and of each only the k + 1 of the
    smallest ids can be among anyone's k nearest, so the others leave the index. Rows that
    take part: see ``usable``; of a zero vector too there is no cosine, so it takes none.
    Vectors are compared with those of as many components. Empty tables give no rows."""
    rows = usable(vectors).filter(F.expr("exists(embedding, x -> x <> 0)"))
    copy = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    # Queries stay even as later copies: they ask, but nobody needs to find them.
    rows = stored(rows.withColumn("_query", query).withColumn("_copy", copy).filter(F.col("_query") | (F.col("_copy") <= k + 1)), "vectors")
    indexed = F.col("_copy") <= k + 1

    def keyed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                sizes = part.column(1).value_lengths().to_numpy(zero_copy_only=False)
                for size in np.unique(sizes):
                    own = part.filter(pa.array(sizes == size))
                    keys = curve_keys(matrix(own.column(1)), curves, dimensions, bits, seed)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), curves).cast(pa.list_(pa.int64()))
                    size_column = pa.array([int(size)] * own.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([*own.columns, size_column, lists], [*own.schema.names, "_size", "_keys"])

    kinds = dict(rows.dtypes)
    schema = f"vec_id long, embedding {kinds['embedding']}, _query boolean, _copy int, _size int, _keys array<long>"
    keyed_rows = rows.select("vec_id", "embedding", "_query", "_copy").mapInArrow(keyed, schema)
    cuts = [i / ranges for i in range(1, ranges)]
    # One row a number of components and curve: the ends of its ranges.
    narrow = keyed_rows.filter(indexed).select("_size", F.posexplode("_keys").alias("_curve", "_key"))
    ends = {
        (r["_size"], r["_curve"]): ranges_of(np.array(r["ends"], np.int64), r["least"], r["n"], k, ranges)
        for r in narrow.groupBy("_size", "_curve").agg(
            F.percentile_approx("_key", cuts, 10_000).alias("ends"), F.min("_key").alias("least"), F.count("*").alias("n")
        ).collect()
    }
    asking = rows.filter("_query").count()
    chunks = max(1, -(-asking // QUERIES))

    def dealt(batches):
        """Index rows to the range they are in, queries to three ranges of each curve."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            asks = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            inside = batch.column(3).to_numpy(zero_copy_only=False) <= k + 1
            sizes = batch.column(4).to_numpy(zero_copy_only=False)
            keys = batch.column(5)
            for size in np.unique(sizes):
                places = np.flatnonzero(sizes == size)
                key = matrix_of_longs(keys.take(pa.array(places)))
                for curve in range(curves):
                    at, parts = ends[int(size), curve]
                    if curve and not len(ends[int(size), 0][0]):
                        continue  # One range in the first curve: that compares all with all.
                    slot = np.searchsorted(at, key[:, curve], side="right")
                    own = np.flatnonzero(inside[places])
                    part = ids[places] % parts[slot]
                    for chunk in range(chunks):
                        yield sent(batch, places[own], size, curve, slot[own], part[own], chunk, False)
                    own = np.flatnonzero(asks[places])
                    for step in (-1, 0, 1):
                        there = own[(slot[own] + step >= 0) & (slot[own] + step <= len(at))]
                        for p in range(parts.max()):
                            cut = there[parts[slot[there] + step] > p]
                            chunk = (ids[places[cut]] // 7) % chunks
                            yield sent(batch, places[cut], size, curve, slot[cut] + step, p, chunk, True)

    def matrix_of_longs(column):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def sent(batch, places, size, curve, slot, part, chunk, query):
        n = len(places)
        whole = lambda v, kind: pa.array(np.broadcast_to(np.asarray(v), (n,)), kind)
        taken = batch.select([0, 1]).take(pa.array(places))
        return pa.RecordBatch.from_arrays(
            [*(whole(v, pa.int32()) for v in (size, curve, slot, part, chunk)), whole(query, pa.bool_()), *taken.columns],
            ["_size", "_curve", "_slot", "_part", "_chunk", "_asks", "vec_id", "embedding"],
        )

    def ranked(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        asks = group.column("_asks").to_numpy(zero_copy_only=False).astype(bool)
        ids = group.column("vec_id").to_numpy()
        unit = directions(matrix(group.column("embedding")))
        found, theirs, candidate = [], ids[~asks], unit[~asks]
        for q, own in zip(ids[asks], unit[asks]):
            scores = candidate @ own
            for p in smallest_first(scores, theirs, k + 1):
                if theirs[p] != q:
                    found.append((int(q), int(theirs[p])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"query_id": pairs[:, 0], "vec_id": pairs[:, 1], "score": exact(pairs, ids, group)})

    def exact(pairs, ids, group):
        values = matrix(group.column("embedding"))
        unit = directions(values)
        a, b = (unit[np.searchsorted(ids, pairs[:, i])] for i in (0, 1))
        return np.clip((a * b).sum(axis=1), -1.0, 1.0)

    grams = "_size int, _curve int, _slot int, _part int, _chunk int, _asks boolean, vec_id long, embedding " + kinds["embedding"]
    near = (
        keyed_rows.mapInArrow(dealt, grams)
        .groupBy("_size", "_curve", "_slot", "_part", "_chunk")
        .applyInArrow(ranked, "query_id long, vec_id long, score double")
    )
    # The same pair has the same score in every curve.
    merged = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found for every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


by_value(__name__)
