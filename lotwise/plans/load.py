"""Page ingestion into the lake, and the incremental load from the lake to the warehouse."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.schemas import (
    LEDGER, LEDGER_KEYS, MERGED_RUNS, MERGES, MONTH, OBSERVATION_COLUMNS, RATE_KEYS, RATES, STORED_OBSERVATIONS,
)
from lotwise.sinks.tables import append_observations, compact_stored, with_month, write_clustered
from lotwise.sources.offer_pages import parse_pages, split_parsed
from lotwise.sources.rate_payloads import parse_rates
from lotwise.sources.tables import (
    has_manifest, late_runs, live_batches, live_runs, merged_before, merged_runs, read_ledger, read_manifest, read_observations,
)
from lotwise.versions import add_part, current_path, delete_folders, folder_names, next_part, parts


def ingest_pages(
    pages: DataFrame, run_id: str, lake: str, rejects: str | None = None, observed_at_col: str = "observed_at"
) -> None:
    """Append the usable pages of a run to the lake. With ``rejects``, the others are
    appended there with their reason. Pages are read and parsed once: both come from the
    parsed rows, which are written first, to a folder of this call that readers of the rejects
    skip and that goes at the end. Runs may be ingested at the same time."""
    parsed = parse_pages(pages, F.lit(run_id), observed_at_col)
    if rejects is None:
        append_observations(split_parsed(parsed)[0], lake)
        return
    spark, call = pages.sparkSession, uuid.uuid4().hex
    between = f"{rejects}/_parsed/{call}"
    try:
        parsed.write.parquet(between)
        good, rejected = split_parsed(spark.read.schema(parsed.schema).parquet(between))
        append_observations(good, lake)
        # A folder for each call: two that write at the same time do not meet.
        rejected.write.partitionBy("scrape_run_id").parquet(f"{rejects}/batch={call}")
    finally:
        delete_folders(spark, [between])


def load_rates(payloads: DataFrame, rates: str) -> None:
    """Append the newest rate of every payload. One bad payload fails the whole load, and
    nothing of it is kept."""
    good, _ = parse_rates(payloads, strict=True)
    good.write.mode("append").parquet(current_path(payloads.sparkSession, rates))


def compact_rates(spark: SparkSession, rates: str) -> None:
    """Keep the last fetch of each rate."""
    compact_stored(spark, rates, RATES, RATE_KEYS, "fetched_at")


def compact_ledger(spark: SparkSession, ledger: str) -> None:
    """Keep the last load of each run."""
    compact_stored(spark, ledger, LEDGER, LEDGER_KEYS, "loaded_at")


def list_runs(observations: DataFrame) -> DataFrame:
    return observations.select("scrape_run_id").distinct().orderBy("scrape_run_id")


def pending_runs(observations: DataFrame, ledger: DataFrame) -> DataFrame:
    """Runs that the ledger does not have."""
    runs = observations.select("scrape_run_id").distinct()
    return runs.join(ledger.select("scrape_run_id"), "scrape_run_id", "left_anti")


def pending_manifest(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Runs, batches and rows that the ledger does not have."""
    return manifest.join(ledger.select("scrape_run_id"), "scrape_run_id", "left_anti").select(*manifest.columns)


def pending_rows(observations: DataFrame, pending: DataFrame) -> DataFrame:
    return observations.join(pending, "scrape_run_id", "left_semi")


def ledger_rows(rows: DataFrame, now: dt.datetime) -> DataFrame:
    """One ledger row per run of ``rows``."""
    counted = rows.groupBy("scrape_run_id").agg(F.count("*").alias("rows_loaded"))
    return counted.select("scrape_run_id", F.lit(now).alias("loaded_at"), "rows_loaded")


def total_loaded(loaded: DataFrame) -> DataFrame:
    """Rows loaded by one call; 0 when nothing was pending."""
    return loaded.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("bigint").alias("rows_loaded"))


def load_runs(rows: DataFrame, warehouse: str) -> None:
    """Write all given runs in one job, ordered by offer, by month and run directories.
    Directories are replaced, so a run left half written by a failed load is not doubled; nor
    is one that was merged since: what has been merged of a run is not written again. Runs for
    months that have been merged are named in a small table afterwards."""
    spark = rows.sparkSession
    stored = with_month(rows.select(*OBSERVATION_COLUMNS), "observed_at")
    bound = merged_before(spark, warehouse)
    if bound:
        stored = stored.join(merged_runs(spark, warehouse), [MONTH, "scrape_run_id"], "left_anti")
    stored = stored.select(*OBSERVATION_COLUMNS, MONTH)
    write_clustered(stored, warehouse, [MONTH, "scrape_run_id"], ["source_offer_id", "observed_at"], replace_partitions=True)
    if bound:
        late = stored.filter(F.col(MONTH) < bound).select(*MERGED_RUNS.fieldNames()).distinct()
        number = next_part(spark, f"{warehouse}/_merged") - 1
        late.coalesce(1).write.mode("append").parquet(f"{warehouse}/_late/after={number}")


def merge_months(spark: SparkSession, warehouse: str, before: str) -> int:
    """Bring the run folders of months before ``before`` (yyyyMM) together, by month and
    ordered by offer and time across runs; gives the number of folders merged. A run that
    comes later for such a month waits in a folder of its own for the next merge. Folders
    are deleted one merge later, so that readers that have begun can end; until then, and
    after a crash at any point, each row is read once: one log entry makes the merged files,
    their runs and the month before which they hold valid together."""
    bound = merged_before(spark, warehouse)
    before = max(before, bound)
    runs = spark.read.schema(STORED_OBSERVATIONS).parquet(warehouse).filter(F.col(MONTH) < before)
    live = live_runs(runs, bound, late_runs(spark, warehouse))
    keys = live.select(*MERGED_RUNS.fieldNames()).distinct()
    count = keys.count()
    if count == 0:
        return 0
    merged = parts(spark, f"{warehouse}/_merged")

    def write(folder: str) -> None:
        write_clustered(live.select(*OBSERVATION_COLUMNS, MONTH), f"{folder}/rows", [MONTH], ["source_offer_id", "observed_at"])
        keys.coalesce(1).write.parquet(f"{folder}/runs")
        spark.createDataFrame([(len(merged) + 1, before)], MERGES).coalesce(1).write.parquet(f"{folder}/bound")

    add_part(spark, f"{warehouse}/_merged", write)
    if merged:
        _delete_runs(spark, warehouse, spark.read.schema(MERGED_RUNS).parquet(f"{merged[-1]}/runs"))
    return count


def _delete_runs(spark: SparkSession, warehouse: str, runs: DataFrame) -> None:
    """Delete the folders of one merge's runs, month by month."""
    for month in [r[0] for r in runs.select(MONTH).distinct().collect()]:
        names = {unquote(name).partition("=")[2]: name for name in folder_names(spark, f"{warehouse}/{MONTH}={month}")}
        gone = runs.filter(F.col(MONTH) == month).toLocalIterator()
        delete_folders(spark, [f"{warehouse}/{MONTH}={month}/{names[r['scrape_run_id']]}" for r in gone if r["scrape_run_id"] in names])


def load_pending(spark: SparkSession, lake: str, warehouse: str, ledger: str, now: dt.datetime) -> int:
    """Load every run of the lake that is not in the ledger; gives the number of rows.

    What is pending is the manifest without the ledger, by a join. Only the batches that have
    pending runs are listed and read: one path for each ingest since the last load comes to
    the driver, and no run. A lake without manifest, stored by other means, is listed whole.
    Rows are counted in the lake's footers. The ledger is written last: a crash before that
    loads the same runs again, into the same folders."""
    loaded = read_ledger(spark, ledger).select("scrape_run_id").distinct()
    pending = pending_manifest(read_manifest(spark, lake), loaded)
    batches = [r[0] for r in pending.select("batch").distinct().collect()]
    if batches:
        rows = live_batches(spark, lake, pending, [f"{lake}/batch={b}" for b in batches])
    elif has_manifest(spark, lake):
        return 0
    else:
        observed = read_observations(spark, lake)
        rows = pending_rows(observed, pending_runs(observed, loaded))
        if rows.isEmpty():
            return 0
    load_runs(rows, warehouse)
    entries = ledger_rows(rows, now).select(*LEDGER.fieldNames())
    entries.coalesce(1).write.mode("append").parquet(current_path(spark, ledger))
    return total_loaded(entries).first()["rows_loaded"]
