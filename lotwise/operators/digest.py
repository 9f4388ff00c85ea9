"""Top rows per group rendered into one text per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group with their position in ``rank``. Each task cuts its own
    rows to ``n`` per group before the shuffle."""
    if not group:
        first = df.orderBy(*order).limit(n)
        # At most n rows are left here, so one unpartitioned window is enough.
        return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def join_lines(
    ranked: DataFrame,
    group: Sequence[str],
    line: Column,
    header: str | None = None,
    budget: int | None = None,
) -> DataFrame:
    """One ``text`` per group: header and lines in rank order, a line end between them.
    With a ``budget``, lines stop before the text would be longer than that. Without rows
    the ungrouped form gives one row with NULL text."""
    lines = ranked.select(*group, "rank", line.alias("line"))
    if budget is not None:
        taken = Window.partitionBy(*group).orderBy("rank")
        start = len(header) if header is not None else -1
        length = F.sum(F.length("line") + 1).over(
            taken.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        lines = lines.withColumn("total", F.lit(start) + length)
    fits = F.col("total") <= budget if budget is not None else F.lit(True)
    kept = F.collect_list(F.when(fits, F.struct("rank", "line")))
    body = F.transform(F.array_sort(kept), lambda entry: entry["line"])
    if header is not None:
        body = F.concat(F.array(F.lit(header)), body)
    text = F.when(F.count("*") > 0, F.array_join(body, "\n"))
    return lines.groupBy(*group).agg(text.alias("text"))
