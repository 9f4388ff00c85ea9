"""Left join to a lookup table with unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 50_000
SALTS = 64


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: Sequence[str],
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Left join on ``key``. The lookup is broadcast only when a count shows that it has
    at most ``max_broadcast_rows`` rows; the count stops at that bound plus one.

    A larger lookup is shuffled. Then ``rows`` is spread over ``salts`` parts per key by
    a hash of the ``spread`` columns (the same on a task retry) and the lookup is repeated
    per part, so that one frequent key does not land in one task.
    """
    if lookup.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        return rows.join(F.broadcast(lookup), key, "left")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")
