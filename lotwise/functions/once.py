"""Keep costly columns from being computed again by what is done with them later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df.select(*columns)``, with each row's columns made in one place.

    A filter on a plain select is moved below it by repeating the selected expressions,
    nested ones included, inside the filter. It is not moved below a generator, so the
    columns go through one that gives exactly one row per row.
    """
    row = F.array(F.struct(*columns))
    return df.select(F.inline(row))
