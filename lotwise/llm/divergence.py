"""Operator 13: how the sources of a language differ in their words.

Arrow kernels count terms inside the scan: lower case, split at what is no term, dictionary
codes, hash grouping. Each task merges its slices into columnar partial counts; Spark sums
these, keeps the common terms of each language, and cuts them into shards of (source, term)
cells, in which the distances of all pairs of sources are summed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import broadcast_if_small, by_value, stored, table

#: What separates terms: ASCII but letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that hold a kept term, added count, scale of a rate, terms listed per group.
LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of text that are split at once, partial counts held by a task, sources of a block.
SLICE, PARTIAL, BLOCK = 4_000_000, 200_000, 256
#: Cells (terms times sources) of a shard, at least: and four for each pair of sources, of which a shard returns a row.
CELLS = 20_000
#: Groups (language and source) up to which their totals are broadcast.
BROADCAST_GROUPS = 100_000

_CUT = re.compile(SEPARATORS)
_SUMS = [("n", "sum"), ("docs", "sum")]


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """(first row, rows) of runs of at most ``SLICE`` bytes; a longer text is a run of its own."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    found, start, held = [], 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > SLICE:
            found.append((start, row - start))
            start, held = row, 0
        held += size
    return found + ([(start, len(sizes) - start)] if len(sizes) > start else [])


def _parts(text: str) -> list[str]:
    """A text cut at separators into parts of about ``SLICE`` characters."""
    parts, at = [], 0
    while len(text) - at > SLICE:
        cut = _CUT.search(text, at + SLICE)
        if cut is None:
            break
        parts.append(text[at : cut.start()])
        at = cut.end()
    return [*parts, text[at:]]


def _per_row(texts: pa.Array) -> tuple[pa.Table, pa.Array]:
    """Counts (row, term as a code, n) of the texts, and the terms that the codes stand for."""
    words = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    terms, rows = words.flatten(), pc.list_parent_indices(words)
    real = pc.greater(pc.binary_length(terms), 0)
    coded = terms.filter(real).dictionary_encode()
    counts = pa.table({"row": rows.filter(real), "term": coded.indices}).group_by(["row", "term"], use_threads=False)
    return counts.aggregate([([], "count_all")]).rename_columns(["row", "term", "n"]), coded.dictionary


def counted(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.Table:
    """lang, source, term, n (places) and docs (rows) of some rows."""
    if len(texts) == 1 and pc.binary_length(texts)[0].as_py() > SLICE:
        # The parts of one document: every term counts as in one row.
        counts, dictionary = _per_row(pa.array(_parts(texts[0].as_py()), pa.string()))
        counts = counts.group_by(["term"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["term", "n"])
        counts = counts.append_column("row", pa.array(np.zeros(len(counts), np.int64)))
    else:
        counts, dictionary = _per_row(texts)
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    width = max(1, len(sources.dictionary))
    group = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
    own = pa.array(group[counts["row"].to_numpy()])
    summed = pa.table({"group": own, "term": counts["term"], "n": counts["n"]}).group_by(["group", "term"], use_threads=False)
    summed = summed.aggregate([("n", "sum"), ("n", "count")])
    group = summed["group"].to_numpy()
    return pa.table({
        "lang": langs.dictionary.take(pa.array(group // width)),
        "source": sources.dictionary.take(pa.array(group % width)),
        "term": dictionary.take(summed["term"].combine_chunks()),
        "n": summed["n_sum"].cast(pa.int64()),
        "docs": summed["n_count"].cast(pa.int64()),
    })


def _merged(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    merged = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate(_SUMS)
    return merged.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Partial counts, several rows a key: lang, source, term, n, docs. Rows count as
    documents whatever their ids; null languages, sources and texts count as ''."""

    def partial(batches):
        held, rows = [], 0
        for batch in batches:
            texts = batch.column(2)
            for first, n in _slices(texts):
                held.append(counted(*(batch.column(i).slice(first, n) for i in range(3))))
                rows += len(held[-1])
                if rows > PARTIAL:
                    held = [_merged(held)]
                    rows = len(held[0])
                    if rows > PARTIAL // 2:
                        yield from held[0].to_batches(max_chunksize=10_000)
                        held, rows = [], 0
        if held:
            yield from _merged(held).to_batches(max_chunksize=10_000)

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    return plain.mapInArrow(partial, "lang string, source string, term string, n long, docs long")


def _rate(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)), exact for any counts."""
    above = f"cast({SCALE} AS decimal(10,0)) * cast({count} + {ADDED} AS decimal(19,0))"
    return F.expr(f"1 + ({above}) div cast({total} + {ADDED} * {terms} AS decimal(19,0))")


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """The terms in at least ``least`` documents of their language: lang, term, n, and
    ``sources``, an array of (source, count), as long as the language has sources at most."""
    sums = F.sum("n").alias("n"), F.sum("docs").alias("docs")
    # One row a source and term first: a hot source or word is summed in every task before.
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(*sums)
    entries = F.collect_list(F.struct("source", F.col("n").alias("count"))).alias("sources")
    return counts.groupBy("lang", "term").agg(*sums, entries).filter(F.col("docs") >= least).drop("docs")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """A row per occurring (lang, source): total, terms (V), lang_total, none (the rate of a
    kept term that does not occur), and into how many shards and blocks of sources the
    language is cut."""
    present = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    cells = kept.selectExpr("lang", "inline(sources)")
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    widths = present.groupBy("lang").agg(F.count("*").alias("_width"))
    langs = widths.join(langs, "lang", "left").na.fill(0, ["terms", "lang_total"])
    joined = present.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
    none = F.when(F.col("terms") > 0, _rate("0", "total", "terms")).otherwise(0)
    width = F.least("_width", F.lit(2 * BLOCK))
    shards = F.greatest(F.lit(1), F.ceil(F.col("terms") * width / F.greatest(F.lit(CELLS), 4 * width * width))).cast("int")
    return joined.select(
        "lang", "source", "total", "terms", "lang_total", none.alias("none"), shards.alias("shards"),
        F.ceil(F.col("_width") / BLOCK).cast("int").alias("blocks"),
    )


def distances(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value``: for all pairs of a language's sources, both
    ways round, the sum over its kept terms of the rates' absolute differences.

    A shard holds some of the terms, for two blocks of at most about ``BLOCK`` sources.
    Only terms that one of them has are in it: where neither has a term, the difference is
    that of the two rates of absent terms, which is added once for all terms."""
    block = F.expr("pmod(xxhash64(source), blocks)")
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least("block", x).alias("i"), F.greatest("block", x).alias("j"))))
    columns = ["lang", "shard", "i", "j", "block", "source", "term", "p", "none", "terms"]
    own = rates.withColumn("shard", F.expr("pmod(xxhash64(term), shards)")).withColumn("block", block)
    own = own.withColumn("pair", pair).select("*", "pair.*").select(columns)
    heads = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("block", block)
    heads = heads.withColumn("pair", pair).select("*", "pair.*").withColumn("term", F.lit(None).cast("string"))
    heads = heads.withColumn("p", F.lit(None).cast("long")).select(columns)

    def summed(group: pa.Table) -> pa.Table:
        head = group.filter(pc.is_null(group["term"])).sort_by("source")
        cells = group.filter(pc.is_valid(group["term"]))
        names, none = head["source"].combine_chunks(), head["none"].to_numpy()
        blocks, first = head["block"].to_numpy(), group["shard"][0].as_py() == 0
        coded = cells["term"].combine_chunks().dictionary_encode()
        rates = np.repeat(none[:, None], len(coded.dictionary), axis=1)
        rates[pc.index_in(cells["source"], names).to_numpy(), coded.indices.to_numpy()] = cells["p"].to_numpy()
        found = []
        for at in range(len(names)):
            others = np.flatnonzero(blocks != blocks[at]) if group["i"][0] != group["j"][0] else np.arange(len(names))
            others = others[others > at]
            absent = np.abs(none[others] - none[at])
            value = np.abs(rates[others] - rates[at]).sum(axis=1) - rates.shape[1] * absent
            found.append((np.full(len(others), at), others, value + (head["terms"][at].as_py() * absent if first else 0)))
        a, b, value = (np.concatenate(c) for c in zip(*found))
        lang = pa.array([group["lang"][0].as_py()] * len(a), pa.string())
        return pa.table({"lang": lang, "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "value": pa.array(value, pa.int64())})

    near = own.unionByName(heads).groupBy("lang", "shard", "i", "j").applyInArrow(summed, "lang string, source string, item string, value long")
    near = near.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return near.unionByName(near.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audited(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: the distances of the other sources of the
    language (part ``pair``), and the ``top`` terms that a source has more often than its
    language (part ``term``). A row is a document, whatever its id. Null texts, languages
    and sources are ''; other columns are not read; an empty table gives no rows. A source
    alone in its language has no pairs; without kept terms all distances are 0."""
    kept = stored(kept_terms(docs, least), "terms")
    groups = stored(group_totals(docs, kept), "groups")
    cells = kept.selectExpr("lang", "term", "n", "inline(sources)")
    known = cells.join(broadcast_if_small(groups, BROADCAST_GROUPS), ["lang", "source"])
    rates = known.withColumn("p", _rate("count", "total", "terms"))
    over = rates.withColumn("q", _rate("n", "lang_total", "terms")).filter("p > q")
    words = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = distances(rates, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    # The cut of the terms is made in every task before the shuffle.
    line = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = words.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= top)
    return ranked.unionByName(pairs.withColumn("rank", F.row_number().over(line)))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of all documents compared within their languages."""
    return audited(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
sized AS (SELECT lang, count(*) AS v, sum(n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
grid AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
rates AS (
  SELECT grid.lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY grid.lang, source) + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q
  FROM grid JOIN sized ON sized.lang = grid.lang),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
listed AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN distances x ON x.lang = g.lang AND x.source = g.source AND x.item = o.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM rates WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


by_value(__name__)
