"""Keep one row per key. All have a map-side partial stage before the shuffle on the key, so a
key that holds a large part of the rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def near_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a key brought together before its aggregate.

    The partial stage of an aggregate that holds text sorts its rows. Rows as they were read
    are as many as a file split holds, which goes to disk, and with keys all over the splits
    the stage leaves most of them. After this shuffle a task has what fits its memory, with
    few keys and all their rows. It is a rebalance, whose partitions may be cut: the shuffle
    on the key itself follows the partial stage, so a frequent key is spread.
    """
    # Not the key itself: equal keys would then count as being in one task, and none be cut.
    spread = df.withColumn("_near", F.hash(*keys))
    return spread.hint("rebalance", "_near").drop("_near")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole row with the greatest ``order`` columns per key; equal ones are decided by
    the remaining columns, so the result does not depend on row order."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def first_seen(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Distinct ``key`` with the smallest ``order`` position it occurs at, in that order."""
    first = F.min(F.struct(*order)).alias("first")
    return df.groupBy(key).agg(first).select(key, "first.*").orderBy(*order)
