"""Operator 7: exact top-k by inner product, term at a time over all candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, stored, table
from lotwise.llm.vectors import matrix, smallest_first, usable

SCALE = 1024
#: Rows of a block of candidates and of a block of queries.
BLOCK, QUERIES = 4096, 16_384
#: Queries that have dense score arrays at the same time.
TOGETHER = 64


def scatter(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all candidates for all queries: each term's postings, weighted by the
    queries that have the term, are added into dense arrays."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(queries.shape[1]):
        having = np.flatnonzero(queries[:, term])
        posting = np.flatnonzero(candidates[:, term])
        if len(having) and len(posting):
            added = np.multiply.outer(queries[having, term], candidates[posting, term])
            if len(having) == len(queries) and len(posting) == len(candidates):
                scores += added
            else:
                scores[np.ix_(having, posting)] += added
    return scores


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """The same as Python integers, of any size."""
    made = np.empty(values.shape, object)
    made[...] = [[int(v) for v in row] for row in values]
    return made


def top_products(vectors: DataFrame, query: Column, k: int = 10, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the k candidates of the largest integer inner
    product with each query; all others are its candidates, if of equally many components.
    Where 62 bits may not hold a product, whole numbers of any size are used; a score of a block's
    best that needs more than 64 bits is an error. ``query`` chooses among ids.

    All queries meet all candidates in blocks: a task holds one block of each. Every block
    gives at most k rows a query, which are merged by a window that keeps k. Copies,
    repeated ids, unusable rows: see ``usable``. No queries or no candidates: no rows."""
    rows = stored(usable(vectors).withColumn("_query", query), "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("_query").alias("q")).first()
    blocks, chunks = max(1, -(-sizes["n"] // BLOCK)), max(1, -(-sizes["q"] // QUERIES))
    rows = rows.withColumn("_size", F.size("embedding"))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int")
    cols = ["_size", "_block", "_chunk", "_query", "vec_id", "embedding"]
    candidates = rows.withColumn("_block", spread).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asking = rows.filter("_query").withColumn("_chunk", part).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = candidates.withColumn("_query", F.lit(False)).select(cols).unionByName(asking.select(cols))

    def best(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        asks = group.column("_query").to_numpy(zero_copy_only=False).astype(bool)
        ids = group.column("vec_id").to_numpy()
        scaled = np.floor(matrix(group.column("embedding")) * scale)
        large = np.abs(scaled).max(initial=0) ** 2 * scaled.shape[1] >= 2.0**62
        scaled = whole_numbers(scaled) if large else scaled.astype(np.int64)
        found = []
        theirs, candidate = ids[~asks], scaled[~asks]
        for at in range(0, int(asks.sum()), TOGETHER):
            own, some = ids[asks][at : at + TOGETHER], scaled[asks][at : at + TOGETHER]
            for q, scores in zip(own, some @ candidate.T if large else scatter(some, candidate)):
                others = theirs != q
                scores, rest = scores[others], theirs[others]
                best = sorted(range(len(rest)), key=lambda p: (-scores[p], rest[p]))[:k] if large else smallest_first(scores, rest, k)
                if any(abs(scores[p]) >= 2**63 for p in best if large):
                    raise ValueError(f"a score of vector {q} needs more than 64 bits")
                found += [(int(q), int(rest[p]), int(scores[p])) for p in best]
        q, v, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})

    near = both.groupBy("_size", "_block", "_chunk").applyInArrow(best, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every hundredth."""
    return top_products(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


# Vectors of the query's own number of components only: others have no inner product with it.
OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(min(embedding), lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(generate_series(1, len(q.w)), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""

by_value(__name__)
