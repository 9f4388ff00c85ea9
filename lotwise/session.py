"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates are UTC dates; variant parsing keeps the last of repeated JSON keys.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Runtime re-planning: coalesce small partitions, split skewed ones. Splitting a skewed
# join is worth an extra shuffle when one key holds a large part of the rows.
EXECUTION = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a longer method; the page parser's would be.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app: str = "lotwise", master: str | None = None, shuffle_partitions: int | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; the cluster's own settings stay otherwise.

    ``shuffle_partitions`` should be about shuffled bytes / 200 MB; the adaptive planner
    merges what turns out to be too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**REQUIRED, **EXECUTION, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"observation dates are UTC dates; session time zone is {zone}")
