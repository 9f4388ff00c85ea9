"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of the nodes in ``links``
    (columns a, b). Smallest labels spread over links and are then looked up as nodes, which
    halves the way that is left; every round is a stored table. Links are aggregated before
    each shuffle, and a node of very many links is a skewed join key, which is split."""
    links = links.filter("a <> b")
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        spread = stored(spread, "spread")
        ahead = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stored(spread.join(ahead, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        if not jumped.filter("label <> old").limit(1).count():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after more ``links`` (a, b): only what these connect anew is
    worked on, component by component."""
    known = labels.select("node", "label")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    fresh = ends.join(known, "node", "left_anti").select("node", F.col("node").alias("label"))
    known = stored(known.unionByName(fresh), "known")
    a = known.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    b = known.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    between = links.join(a, "a").join(b, "b").filter("label_a <> label_b")
    joined = components(between.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct())
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("root"))
    return stored(known.join(joined, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")


by_value(__name__)
