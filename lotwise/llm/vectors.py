"""Vectors that take part in a search, and blocks of bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import by_value


def usable(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part: no null id, vector or
    component, none that is infinite or not a number, at least one component. A repeated id
    counts once, with the smallest of its vectors."""
    fine = f"size({embedding}) > 0 AND forall({embedding}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    rows = vectors.filter(F.col(key).isNotNull() & F.expr(f"coalesce({fine}, false)"))
    return rows.groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(embedding).alias("embedding"))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, as doubles."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def smallest_first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id. ``ids`` ascend."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))]


by_value(__name__)
