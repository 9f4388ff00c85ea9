"""Stored tables that can be replaced without a moment at which they are missing.

A new version is written beside the old one; a row in a small log then names it. Readers
take the newest version in the log, so a job that dies while writing changes nothing. Until
a table is replaced for the first time, its files lie in the table's folder itself. There is
one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = T.StructType([T.StructField("number", T.LongType()), T.StructField("version", T.StringType())])
#: Versions that stay: the current one and that which running readers may still use.
KEPT = 2


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored table, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _log(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The newest versions, newest first."""
    rows = read_or_empty(spark, f"{path}/_log", LOG).orderBy(F.desc("number")).limit(KEPT + 1).collect()
    return [(r["number"], r["version"]) for r in rows]


def current_path(spark: SparkSession, path: str) -> str:
    """Folder that the table's rows are in now; also where rows are appended."""
    log = _log(spark, path)
    return f"{path}/_versions/{log[0][1]}" if log else path


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, current_path(spark, path), schema)


def replace_table(df: DataFrame, path: str) -> None:
    """Write ``df``, which may read the current version, as the table's next version and
    switch to it."""
    spark = df.sparkSession
    log = _log(spark, path)
    number = log[0][0] + 1 if log else 1
    version = f"v{number}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/_versions/{version}")
    # One file, which is there as a whole or not at all.
    spark.createDataFrame([(number, version)], LOG).coalesce(1).write.mode("append").parquet(f"{path}/_log")
    for _, old in log[KEPT - 1 :]:
        _delete(spark, f"{path}/_versions/{old}")


def parts(spark: SparkSession, path: str) -> list[str]:
    """Folders of a table that grows by parts, in their order."""
    log = read_or_empty(spark, f"{path}/_log", LOG).orderBy("number").collect()
    return [f"{path}/_versions/{r['version']}" for r in log]


def add_part(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Add what ``write`` writes into a folder; it belongs to the table once that is done."""
    number = next_part(spark, path)
    version = f"v{number}-{uuid.uuid4().hex}"
    write(f"{path}/_versions/{version}")
    spark.createDataFrame([(number, version)], LOG).coalesce(1).write.mode("append").parquet(f"{path}/_log")


def next_part(spark: SparkSession, path: str) -> int:
    """Number of the part that is added next, from 1."""
    return len(parts(spark, path)) + 1


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; nothing below it is listed."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
