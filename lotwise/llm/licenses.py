"""Operator 1: license scans by diagonal voting.

Rolling word 3-grams of documents are joined with those of known texts. A match votes for
the diagonal document position minus template position: the words of a phrase that stand
consecutively vote for one diagonal, a notice with words added or left out for a few
neighbouring ones, which are merged. A span counts if enough of the template's 3-grams
stand in its best window of twice the template's words; single fragments elsewhere in the
span do not matter. Only DataFrame functions run on the executors.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, table

K = 3
#: Diagonals this close vote for the same span.
NEAR = 4
#: Share of a template's 3-grams that a span must hold.
COVERED = 0.75
#: A notice may stand among as many other words as make this many times its own.
WIDE = 2
#: Templates of up to this many 3-grams are broadcast; more are joined by a shuffle.
BROADCAST_GRAMS = 200_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose every place counts, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of public license texts, found by coverage.
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
    " associated documentation files (the Software), to deal in the Software without restriction",
    "apache-2": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the"
    " GNU General Public License as published by the Free Software Foundation",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    exact: bool

    @staticmethod
    def of(label: str, text: str, exact: bool) -> Template:
        words = tuple(re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER))))
        if len(words) < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        return Template(label, words, exact)


def default_templates() -> list[Template]:
    exact = [Template.of(label, text, True) for text, label in PHRASES.items()]
    return exact + [Template.of(label, text, False) for label, text in NOTICES.items()]


def word_list(text: str = "text") -> Column:
    """Words of a text in order, A-Z in lower case; of null, none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def spans(docs: DataFrame, templates: list[Template], row: str, text: str = "text", near: int = NEAR) -> DataFrame:
    """Per row and template, every merged span: ``template`` (place in the list), ``start``
    and ``stop`` (words) and ``coverage`` (0 to 1), which for a template that need not stand exactly
    is that of the best window of ``WIDE`` times its words. One more row per input row, with a null
    template, carries ``n_words``. ``row`` identifies the rows."""
    spark = docs.sparkSession
    grams = [(i, p, *t.words[p : p + K]) for i, t in enumerate(templates) for p in range(len(t.words) - K + 1)]
    known = spark.createDataFrame(grams, "template int, place int, k0 string, k1 string, k2 string")
    known = known.withColumn("_hash", F.xxhash64("k0", "k1", "k2"))
    if len(grams) <= BROADCAST_GRAMS:
        known = F.broadcast(known)
    words = docs.select(F.col(row).alias("_row"), word_list(text).alias("_words"))
    placed = words.select("_row", "_words", F.size("_words").alias("_n"), F.posexplode_outer("_words").alias("_p", "_w"))
    rolling = placed.select(
        "_row", "_n", F.coalesce("_p", F.lit(0)).alias("_p"), "_w",
        F.get("_words", F.col("_p") + 1).alias("_w1"), F.get("_words", F.col("_p") + 2).alias("_w2"),
    )
    # Equal hashes are compared word by word, so a vote is a true match.
    votes = rolling.join(
        known,
        (F.xxhash64("_w", "_w1", "_w2") == known["_hash"])
        & (F.col("_w") == known["k0"]) & (F.col("_w1") == known["k1"]) & (F.col("_w2") == known["k2"]),
        "left",
    ).filter("template IS NOT NULL OR _p = 0")
    of = lambda value: F.create_map(*(x for i, t in enumerate(templates) for x in (F.lit(i), F.lit(value(t)))))[F.col("template")]
    loose = F.when(~of(lambda t: t.exact), F.struct(F.col("_p").alias("p"), "place"))
    diagonals = votes.groupBy("_row", "template", (F.col("_p") - F.col("place")).alias("_diagonal")).agg(
        F.collect_set("place").alias("_places"), F.collect_list(loose).alias("_votes"), F.min("_p").alias("_first"), F.max("_p").alias("_last"),
        F.max("_n").alias("n_words"),
    )
    # A window is one document and template: as large as that document at most.
    line = Window.partitionBy("_row", "template").orderBy("_diagonal")
    fresh = F.col("_diagonal") - F.lag("_diagonal").over(line) > F.coalesce(of(lambda t: 0 if t.exact else near), F.lit(0))
    grouped = diagonals.withColumn("_span", F.sum(F.coalesce(fresh.cast("int"), F.lit(0))).over(line))
    merged = grouped.groupBy("_row", "template", "_span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("_places")))).alias("_held"),
        F.sort_array(F.flatten(F.collect_list("_votes"))).alias("_votes"),
        F.min("_first").alias("start"),
        (F.max("_last") + K).alias("stop"),
        F.min("_diagonal").alias("diagonal"),
        F.max("n_words").alias("n_words"),
    )
    # As many votes as a window can have follow each vote, so the work grows with the votes.
    most = of(lambda t: WIDE * len(t.words) * max(Counter(zip(t.words, t.words[1:], t.words[2:])).values()))
    reach = of(lambda t: WIDE * len(t.words) - K)
    ahead = lambda i: F.slice("_votes", i + 1, most)
    close = lambda i: F.filter(ahead(i), lambda v: v["p"] <= F.get("_votes", i)["p"] + reach)
    windows = F.transform(F.sequence(F.lit(0), F.size("_votes") - 1), lambda i: F.size(F.array_distinct(F.transform(close(i), lambda v: v["place"]))))
    best = F.when(F.size("_votes") > 0, F.when(F.col("stop") - F.col("start") <= of(lambda t: WIDE * len(t.words)), F.col("_held")).otherwise(F.array_max(windows)))
    return merged.withColumn("coverage", F.coalesce(best, "_held") / of(lambda t: len(t.words) - K + 1)).drop("_votes")


def scanned(docs: DataFrame, templates: list[Template] | None = None, covered: float = COVERED, text: str = "text") -> DataFrame:
    """Per input row of ``doc_id``: n_words, n_base, first_word, last_word, base_labels,
    labels and score (the best coverage, 1 where an exact phrase stands). Null and empty
    texts have no words and empty labels; repeated rows and null ids give a row each. Texts of any
    length are scanned whole: the arrays of a row are as long as its text at most. Only
    ``doc_id`` and the text are read, so other columns may have any names."""
    templates = default_templates() if templates is None else templates
    rows = docs.select("doc_id", text).withColumn("_id", F.struct("doc_id", F.monotonically_increasing_id().alias("n")))
    found = spans(rows, templates, "_id", text)
    label = F.create_map(*(x for i, t in enumerate(templates) for x in (F.lit(i), F.lit(t.label))))[F.col("template")]
    exact = F.create_map(*(x for i, t in enumerate(templates) for x in (F.lit(i), F.lit(t.exact))))[F.col("template")]
    base = exact & (F.col("coverage") == 1)
    other = ~exact & (F.col("coverage") >= covered)
    found = found.withColumn("_base", F.coalesce(base, F.lit(False))).withColumn("_other", F.coalesce(other, F.lit(False)))
    found = found.withColumn("_label", label)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("_label")))), ",")
    score = F.when(F.col("_base"), 1.0).when(F.col("_other"), F.col("coverage")).otherwise(0.0)
    return found.groupBy("_row").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if("_base").alias("n_base"),
        F.min(F.when(F.col("_base"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("_base"), F.col("diagonal"))).cast("long").alias("last_word"),
        joined(F.col("_base")).alias("base_labels"),
        joined(F.col("_base") | F.col("_other")).alias("labels"),
        F.max(score).alias("score"),
    ).select(F.col("_row.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return scanned(table(spark, sf_dir, "documents"))


def op1_sql(templates: list[Template] | None = None, near: int = NEAR, covered: float = COVERED) -> str:
    """The same as SQL, over documents with distinct ids."""
    templates = default_templates() if templates is None else templates
    grams = ", ".join(
        f"({i}, {p}, '{' '.join(t.words[p : p + K])}', '{t.label}', {str(t.exact).lower()}, {len(t.words)})"
        for i, t in enumerate(templates) for p in range(len(t.words) - K + 1)
    )
    return f"""
WITH grams(template, place, gram, label, exact, size) AS (VALUES {grams}),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
rolling AS (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - {K - 1})) AS p FROM words WHERE len(w) >= {K}),
votes AS (
  SELECT doc_id, template, label, exact, size, place, p - 1 AS p, p - 1 - place AS diagonal
  FROM rolling JOIN grams ON w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] = gram),
steps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER line > CASE WHEN exact THEN 0 ELSE {near} END THEN 1 ELSE 0 END AS fresh
  FROM votes WINDOW line AS (PARTITION BY doc_id, template ORDER BY diagonal, p)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal, p) AS span FROM steps),
windows AS (
  SELECT a.doc_id, a.template, a.span, a.p, count(DISTINCT b.place) AS held
  FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND a.template = b.template AND a.span = b.span
    AND b.p BETWEEN a.p AND a.p + 2 * a.size - {K}
  WHERE NOT a.exact GROUP BY ALL),
spans AS (
  SELECT n.doc_id, label, exact, min(diagonal) AS diagonal,
    CAST(CASE WHEN exact THEN count(DISTINCT place) ELSE max(held) END AS DOUBLE) / (size - {K - 1}) AS coverage
  FROM numbered n LEFT JOIN windows w ON w.doc_id = n.doc_id AND w.template = n.template AND w.span = n.span AND w.p = n.p
  GROUP BY n.doc_id, n.template, label, exact, size, n.span),
judged AS (
  SELECT *, exact AND coverage = 1 AS base, NOT exact AND coverage >= {covered} AS other FROM spans),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(diagonal) FILTER (WHERE base) AS first_word,
    max(diagonal) FILTER (WHERE base) AS last_word,
    list(DISTINCT label) FILTER (WHERE base) AS base_labels, list(DISTINCT label) FILTER (WHERE base OR other) AS labels,
    max(CASE WHEN base THEN 1.0::DOUBLE WHEN other THEN coverage ELSE 0.0::DOUBLE END) AS score
  FROM judged GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(labels), ','), '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM words LEFT JOIN found ON words.doc_id = found.doc_id
"""


by_value(__name__)
