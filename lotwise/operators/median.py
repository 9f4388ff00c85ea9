"""Exact median per group without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per factor e; a bucket spans about 1/4096 of its value.
STEPS = 4096


def value_bucket(value: Column) -> Column:
    """Bucket number that never falls as the value grows (NaN counts as the greatest)."""
    steps = F.floor(F.log1p(F.abs(value)) * STEPS)
    return F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(F.signum(value).cast("long") * steps)


def price_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, minimum, exact interpolated median and maximum of ``value`` per group; both
    ``keys`` and ``value`` must not be NULL.

    Equal values are counted first. Counts per bucket, at most a few thousand per factor e
    of the value range, then tell which bucket (two at most) holds the middle ranks, and
    only the distinct values of that bucket are ordered. For money that is at most the
    number of cents in 1/4096 of a price, times the number of currencies converted from.
    """
    keys = list(keys)
    values = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    # Both readers of the values need a bucket. Said here, it is the same exchange for both;
    # said by the join alone, the values would be aggregated and shuffled twice.
    values = values.withColumn("_bucket", value_bucket(F.col("_value"))).filter(F.col("_bucket").isNotNull())

    group = Window.partitionBy(*keys)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (
        values.groupBy(*keys, "_bucket")
        .agg(
            F.sum("_n").alias("_in_bucket"),
            F.min("_value").alias("_low"),
            F.max("_value").alias("_high"),
        )
        .select(
            *keys,
            "_bucket",
            F.sum("_in_bucket").over(group).alias("_total"),
            F.min("_low").over(group).alias("_minimum"),
            F.max("_high").over(group).alias("_maximum"),
            F.sum("_in_bucket").over(upto).alias("_upto"),
            (F.sum("_in_bucket").over(upto) - F.col("_in_bucket")).alias("_before"),
        )
    )
    # Zero-based middle ranks; equal when the count is odd.
    lower = F.expr("(_total - 1) div 2")
    upper = F.expr("_total div 2")
    middle = buckets.filter((F.col("_upto") > lower) & (F.col("_before") <= upper))

    within = group.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.join(middle, [*keys, "_bucket"]).withColumn(
        "_reach", F.min("_before").over(group) + F.sum("_n").over(within)
    )
    low = F.min(F.when(F.col("_reach") > lower, F.col("_value")))
    high = F.min(F.when(F.col("_reach") > upper, F.col("_value")))
    return ranked.groupBy(*keys).agg(
        F.max("_total").alias("count"),
        F.min("_minimum").alias("minimum"),
        (low * 0.5 + high * 0.5).alias("median"),
        F.max("_maximum").alias("maximum"),
    )
