"""Writers of the stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.operators.latest import latest_per_key
from lotwise.schemas import MANIFEST, MONTH, OBSERVATION_COLUMNS, OBSERVATIONS
from lotwise.sources.tables import read_manifest
from lotwise.versions import current_path, delete_folders, folder_names, read_current, replace_table


def append_observations(observations: DataFrame, path: str) -> None:
    """Append to the lake as one batch, made on first use. A batch has a folder of its own with
    a folder for each run; rows are rebalanced by run first, which gives files of the advisory
    size and splits a large run. The manifest is written last: a batch that it does not name, of a
    job that died, is never read. Batches that are written at the same time do not meet."""
    spark, batch = observations.sparkSession, uuid.uuid4().hex
    rows = observations.select(*OBSERVATION_COLUMNS).hint("rebalance", "scrape_run_id")
    rows.write.partitionBy("scrape_run_id").parquet(f"{path}/batch={batch}")
    if not folder_names(spark, f"{path}/batch={batch}"):
        return
    # Counted in the footers: no column is read.
    written = spark.read.schema(OBSERVATIONS).parquet(f"{path}/batch={batch}")
    manifest_rows(written.withColumn("batch", F.lit(batch))).coalesce(1).write.parquet(f"{path}/_manifest/part={batch}")


def manifest_rows(written: DataFrame) -> DataFrame:
    """A manifest's rows: how many each run of each batch has."""
    return written.groupBy("scrape_run_id", "batch").agg(F.count("*").alias("rows")).select(*MANIFEST.fieldNames())


def compact_manifest(spark: SparkSession, path: str) -> None:
    """Bring the manifest's parts, one for each batch, into one. Rows that two parts have, after
    a crash, count once. Nothing may be loaded from the lake meanwhile."""
    old = folder_names(spark, f"{path}/_manifest")
    read_manifest(spark, path).coalesce(1).write.parquet(f"{path}/_manifest/part={uuid.uuid4().hex}")
    delete_folders(spark, [f"{path}/_manifest/{name}" for name in old])


def with_month(df: DataFrame, timestamp: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(timestamp, "yyyyMM"))


def write_clustered(
    df: DataFrame, path: str, partition: Sequence[str], order: Sequence[str], replace_partitions: bool = False
) -> None:
    """Store by ``partition`` directories, ordered by ``order`` inside. Range partitioning
    on both splits a large directory over tasks and keeps key ranges of files apart.

    With ``replace_partitions`` the directories written to are replaced and others stay,
    so writing the same rows again leaves the table as it was.
    """
    keys = [*partition, *order]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = rows.write.partitionBy(*partition)
    if replace_partitions:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def compact_latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Last version per key of an append-only table."""
    return latest_per_key(df, keys, [version])


def compact_stored(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: str) -> None:
    """Rewrite an append-only table with the last version per key. Readers see the old rows
    or the new ones; rows appended later go to the new ones."""
    replace_table(compact_latest(read_current(spark, path, schema), keys, version), path)


def materialize(df: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """Replace a table with ``df``, whose files hold ranges of ``order_by`` in order."""
    replace_table(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by), path)


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A materialized table."""
    return spark.read.parquet(current_path(spark, path))
