"""Readers of the stored tables. Schemas are given, never inferred."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.schemas import (
    LEDGER, MANIFEST, MERGED_RUNS, MERGES, MONTH, OBSERVATION_COLUMNS, OBSERVATIONS, RATES, STORED_OBSERVATIONS,
)
from lotwise.session import require_utc
from lotwise.versions import current_path, folder_names, parts, read_current, read_or_empty

#: Runs of a lake up to which they are broadcast; more are joined by a shuffle.
BROADCAST_RUNS = 200_000


def read_observations(
    spark: SparkSession,
    path: str,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> DataFrame:
    """Observations, optionally with ``since <= observed_at < until`` (UTC). The bounds are
    also put on the month directories, which a filter on ``observed_at`` alone would not
    prune. The table must then be stored by month. Months that have been merged are read
    from there, and their run folders left out; of a lake the batches that its manifest names."""
    require_utc(spark)
    stored = _stored(spark, path, since is not None or until is not None)
    if since is not None:
        stored = stored.filter((F.col(MONTH) >= f"{since:%Y%m}") & (F.col("observed_at") >= F.lit(since)))
    if until is not None:
        stored = stored.filter((F.col(MONTH) <= f"{until:%Y%m}") & (F.col("observed_at") < F.lit(until)))
    return stored.select(*OBSERVATION_COLUMNS)


def _stored(spark: SparkSession, path: str, by_month: bool) -> DataFrame:
    """All rows of a stored table, with the month where it is stored by month. What is live is
    told by small tables that are joined, so the plan is as large whatever they hold: in a lake
    the batches of the manifest; of months that have been merged the merged files, and the
    folders of runs that came later."""
    if has_manifest(spark, path):
        return live_batches(spark, path, read_manifest(spark, path))
    merged = parts(spark, f"{path}/_merged")
    if not merged:
        return spark.read.schema(STORED_OBSERVATIONS if by_month else OBSERVATIONS).parquet(path)
    runs = spark.read.schema(STORED_OBSERVATIONS).parquet(path)
    stored = live_runs(runs, merged_before(spark, path), late_runs(spark, path))
    for part in merged:
        stored = stored.unionByName(spark.read.schema(STORED_OBSERVATIONS).parquet(f"{part}/rows"))
    return stored


def live_runs(stored: DataFrame, bound: str, late: DataFrame) -> DataFrame:
    """Rows of run folders that no merge holds: of months from ``bound`` on, and of the
    ``late`` months and runs before it. The folders of others are not read where ``late`` is
    broadcast, which is as long as it is of bounded size."""
    before = stored.filter(F.col(MONTH) < bound).join(_checked(late.select(MONTH, "scrape_run_id")), [MONTH, "scrape_run_id"], "left_semi")
    return stored.filter(F.col(MONTH) >= bound).unionByName(before.select(*stored.columns))


def _checked(keys: DataFrame) -> DataFrame:
    """Distinct keys, marked for broadcast if they are few, which is counted."""
    keys = keys.distinct()
    return F.broadcast(keys) if keys.limit(BROADCAST_RUNS + 1).count() <= BROADCAST_RUNS else keys


def has_manifest(spark: SparkSession, path: str) -> bool:
    return bool(folder_names(spark, f"{path}/_manifest"))


def read_manifest(spark: SparkSession, lake: str) -> DataFrame:
    """Runs, batches and rows of a lake; no rows before the first ingest."""
    return read_or_empty(spark, f"{lake}/_manifest", MANIFEST).select(*MANIFEST.fieldNames()).distinct()


def live_batches(spark: SparkSession, lake: str, runs: DataFrame, folders: Iterable[str] | None = None) -> DataFrame:
    """Rows of the given runs and batches of a lake. Only ``folders`` are listed if they are
    given; what is read of them is pruned by the runs when these are broadcast."""
    keys = _checked(runs.select("batch", "scrape_run_id"))
    schema = T.StructType([*OBSERVATIONS.fields, MANIFEST["batch"]])
    rows = spark.read.schema(schema).option("basePath", lake).parquet(*([lake] if folders is None else folders))
    return rows.join(keys, ["batch", "scrape_run_id"], "left_semi").select(*OBSERVATION_COLUMNS)


def merged_before(spark: SparkSession, path: str) -> str:
    """The month before which months have been merged; '' if none has."""
    merged = parts(spark, f"{path}/_merged")
    if not merged:
        return ""
    return spark.read.schema(MERGES).parquet(*(f"{p}/bound" for p in merged)).agg(F.max(MONTH)).first()[0]


def merged_runs(spark: SparkSession, path: str) -> DataFrame:
    """Month and run of all that has been merged."""
    merged = parts(spark, f"{path}/_merged")
    return spark.read.schema(MERGED_RUNS).parquet(*(f"{p}/runs" for p in merged)) if merged else spark.createDataFrame([], MERGED_RUNS)


def late_runs(spark: SparkSession, path: str) -> DataFrame:
    """Month and run of what has come for merged months since the last merge."""
    number = len(parts(spark, f"{path}/_merged"))
    return read_or_empty(spark, f"{path}/_late/after={number}", MERGED_RUNS).distinct()


def month_folders(spark: SparkSession, path: str) -> dict[tuple[str, str], str]:
    """Folder of each month and run of a table stored by both, merged or not."""
    found = {}
    for file in spark.read.schema(STORED_OBSERVATIONS).parquet(path).inputFiles():
        folder = re.match(rf"(.*/{MONTH}=([^/]*)/scrape_run_id=([^/]*))/", unquote(file))
        if folder:
            found[folder[2], unquote(folder[3])] = folder[1]
    return found


def read_newest(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """Observations of the newest months that together hold at least ``rows`` rows; for top
    lists by time, which need nothing older. Rows per month come from the file footers."""
    require_utc(spark)
    stored = _stored(spark, path, by_month=True)
    months = stored.groupBy(MONTH).agg(F.count("*").alias("stored"))
    # One row per month, so one window over all of them is enough.
    held = F.sum("stored").over(Window.orderBy(F.desc(MONTH)))
    enough = months.withColumn("held", held).filter(F.col("held") >= rows)
    first = enough.agg(F.max(MONTH).alias("first")).first()["first"]
    if first is not None:
        stored = stored.filter(F.col(MONTH) >= first)
    return stored.select(*OBSERVATION_COLUMNS)


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    require_utc(spark)
    return spark.read.schema(RATES).parquet(current_path(spark, path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Load ledger; empty before the first load."""
    return read_current(spark, path, LEDGER)


def read_run(observations: DataFrame, run_id: str) -> DataFrame:
    """One run; only its directory is read where the table is stored by run."""
    return observations.filter(F.col("scrape_run_id") == run_id)


def rows_to_observations(spark: SparkSession, rows: Iterable[Mapping[str, Any]]) -> DataFrame:
    """In-memory records as a typed table."""
    return spark.createDataFrame([tuple(row[c] for c in OBSERVATION_COLUMNS) for row in rows], OBSERVATIONS)
