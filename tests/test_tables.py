"""Stored tables: writers, readers, incremental load and the daily build."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from lotwise import versions
from lotwise.plans import alerts, daily, load, marts, quality, reports, staging
from lotwise.schemas import LEDGER_KEYS, OBSERVATIONS, RATE_KEYS
from lotwise.sinks import tables as sinks
from lotwise.sources import tables as sources
from tests.samples import at, observation, observations, rates
from verification import inputs

NOW = at("2026-01-01 00:00:00")


def same(left, right):
    columns = right.columns
    left = left.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def typed(df):
    """Given timestamps carry no zone; stored ones do."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in OBSERVATIONS.fields])


@pytest.fixture(scope="module")
def obs(models):
    return typed(models.obs())


@pytest.fixture(scope="module")
def raw_rates(models):
    return models.rates().withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def test_append_and_read_one_run(spark, tmp_path, obs):
    lake = str(tmp_path / "lake")
    early, late = obs.filter("scrape_run_id < 'run-1995-01'"), obs.filter("scrape_run_id >= 'run-1995-01'")
    sinks.append_observations(early, lake)
    sinks.append_observations(late, lake)
    stored = sources.read_observations(spark, lake)
    assert stored.schema.fieldNames() == OBSERVATIONS.fieldNames()
    assert same(stored, obs)
    run = sources.read_run(stored, "run-1995-06")
    assert re.search(r"PartitionFilters: \[[^\]]*scrape_run_id", plan(run))
    assert same(run, obs.filter("scrape_run_id = 'run-1995-06'"))


def test_month_bounds_reach_the_directories(spark, tmp_path, obs):
    path = str(tmp_path / "raw")
    sinks.write_clustered(sinks.with_month(obs, "observed_at"), path, ["observed_month"], ["source_offer_id", "observed_at"])
    since, until = at("1995-02-10 00:00:00"), at("1995-04-01 00:00:00")
    found = sources.read_observations(spark, path, since, until)
    assert same(found, obs.filter((F.col("observed_at") >= F.lit(since)) & (F.col("observed_at") < F.lit(until))))
    text = plan(found)
    assert re.search(r"PartitionFilters: \[[^\]]*observed_month", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(observed_at", text)
    assert "observed_month=199502" in str(glob.glob(f"{path}/*"))


def test_newest_months_are_enough_for_top_lists(spark, tmp_path, obs):
    path = str(tmp_path / "raw")
    load.load_runs(obs, path)
    whole = alerts.latest_observations(sources.read_observations(spark, path))
    newest = sources.read_newest(spark, path, alerts.TOP_OFFERS)
    assert re.search(r"PartitionFilters: \[[^\]]*observed_month", plan(newest))
    assert same(alerts.latest_observations(newest), whole)
    assert sources.read_newest(spark, path, 10**9).count() == obs.count()


def test_large_directory_is_split_and_ordered(spark, tmp_path, obs):
    path = str(tmp_path / "hot")
    hot = obs.withColumn("observed_month", F.lit("202401")).withColumn("source_offer_id", F.lit("one"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_clustered(hot, path, ["observed_month"], ["source_offer_id", "observed_at"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{path}/observed_month=202401/*.parquet")
    assert len(files) > 4
    ranges = []
    for file in files:
        times = [r.observed_at for r in spark.read.parquet(file).select("observed_at").collect()]
        assert times == sorted(times)
        ranges.append((times[0], times[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_rows_to_observations(spark):
    rows = [observation(source_offer_id=str(i)) for i in range(3)]
    table = sources.rows_to_observations(spark, rows)
    assert table.schema == OBSERVATIONS and table.count() == 3


def test_session_zone_is_checked(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        with pytest.raises(ValueError, match="UTC"):
            sources.read_rates(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_load_twice_is_load_once(spark, tmp_path, obs):
    lake, warehouse, ledger = (str(tmp_path / n) for n in ("lake", "warehouse", "ledger"))
    early, late = obs.filter("scrape_run_id < 'run-1995-01'"), obs.filter("scrape_run_id >= 'run-1995-01'")
    sinks.append_observations(early, lake)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == early.count()
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 0
    sinks.append_observations(late, lake)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW + dt.timedelta(days=1)) == late.count()
    assert same(sources.read_observations(spark, warehouse), obs)
    kept = sources.read_ledger(spark, ledger)
    counts = obs.groupBy("scrape_run_id").agg(F.count("*").alias("rows_loaded"))
    assert same(kept.drop("loaded_at"), counts)
    assert same(sinks.compact_latest(kept.unionAll(kept), LEDGER_KEYS, "loaded_at"), kept)


def test_crash_before_the_ledger_leaves_no_duplicates(spark, tmp_path, obs, monkeypatch):
    lake, warehouse, ledger = (str(tmp_path / n) for n in ("lake", "warehouse", "ledger"))
    sinks.append_observations(obs, lake)

    def crash(rows, now):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(load, "ledger_rows", crash)
        with pytest.raises(RuntimeError):
            load.load_pending(spark, lake, warehouse, ledger, NOW)
    assert sources.read_observations(spark, warehouse).count() == obs.count()
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == obs.count()
    assert same(sources.read_observations(spark, warehouse), obs)


@pytest.mark.parametrize("runs", [1, 2000])
def test_only_pending_runs_are_read(spark, tmp_path, runs):
    """Runs that the ledger has are spoilt after their load: reading any would fail."""
    lake, warehouse, ledger = (str(tmp_path / n) for n in ("lake", "warehouse", "ledger"))
    sinks.append_observations(observations(spark, {"scrape_run_id": "old:1"}, {"scrape_run_id": "old 2%"}), lake)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 2
    spoil = glob.glob(f"{lake}/batch=*/*/*.parquet")
    assert len(spoil) == 2
    for file in spoil:
        with open(file, "wb") as spoilt:
            spoilt.write(b"spoilt")
        os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    fresh = spark.range(runs * 3).select(
        *[
            F.concat(F.lit("run-"), (F.col("id") % runs).cast("string")).alias(f.name)
            if f.name == "scrape_run_id"
            else (F.col("id").cast("string").alias(f.name) if f.name == "source_offer_id" else F.lit(observation()[f.name]).cast(f.dataType).alias(f.name))
            for f in OBSERVATIONS.fields
        ]
    )
    sinks.append_observations(fresh, lake)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == runs * 3
    kept = sources.read_ledger(spark, ledger)
    assert kept.count() == runs + 2 and kept.filter("rows_loaded = 3").count() == runs
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 0


def test_compacted_tables_read_the_same(spark, tmp_path, obs, raw_rates):
    lake, warehouse, ledger, rate_path = (str(tmp_path / n) for n in ("lake", "warehouse", "ledger", "rates"))
    sinks.append_observations(obs, lake)
    load.load_pending(spark, lake, warehouse, ledger, NOW)
    loaded = sources.read_ledger(spark, ledger).collect()
    raw_rates.write.parquet(rate_path)
    before = daily.build_daily(spark, warehouse, rate_path, str(tmp_path / "before"), money_scale=2)
    load.compact_rates(spark, rate_path)
    load.compact_ledger(spark, ledger)
    assert sorted(sources.read_ledger(spark, ledger).collect()) == sorted(loaded)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 0
    kept = sources.read_rates(spark, rate_path)
    assert kept.count() == raw_rates.select(*RATE_KEYS).distinct().count() < raw_rates.count()
    after = daily.build_daily(spark, warehouse, rate_path, str(tmp_path / "after"), money_scale=2)
    for name in daily.ORDER_KEYS:
        assert same(before[name], after[name]), name
    # Later rates are appended to what is kept.
    extra = rates(spark, ("2030-01-01", "EUR", "PLN", "5", "2030-01-01 00:00:00"))
    extra.write.mode("append").parquet(versions.current_path(spark, rate_path))
    assert sources.read_rates(spark, rate_path).count() == kept.count() + 1


def test_crash_while_replacing_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.materialize(spark.range(5), path, ["id"])
    broken = spark.range(10).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.materialize(broken, path, ["id"])
    assert sinks.read_back(spark, path).count() == 5
    for n in (6, 7, 8):
        sinks.materialize(spark.range(n), path, ["id"])
        assert sinks.read_back(spark, path).count() == n
    # The one before the current one stays for its readers; a crash leaves files of no version.
    assert len([v for v in os.listdir(f"{path}/_versions") if v[:2] in ("v3", "v4")]) == 2


def test_fact_files_hold_ranges_of_its_key(spark, tmp_path, obs):
    path = str(tmp_path / "fact")
    fact = marts.fct_offer_observations(obs)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.materialize(fact, path, daily.ORDER_KEYS["fct__offer_observations"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = []
    for file in glob.glob(f"{versions.current_path(spark, path)}/*.parquet"):
        keys = [(r.offer_key, r.observed_at) for r in spark.read.parquet(file).select("offer_key", "observed_at").collect()]
        assert keys == sorted(keys)
        spans.append((keys[0], keys[-1]))
    spans.sort()
    assert len(spans) > 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_merged_months(spark, tmp_path, obs, monkeypatch):
    path = str(tmp_path / "raw")
    # Offers of a month in two runs each, and one month that stays open.
    split = F.concat("scrape_run_id", F.when(F.col("source_offer_id") % 2 == 0, "-a").otherwise("-b"))
    rows = typed(obs.filter("observed_at < '1995-06-01'").withColumn("scrape_run_id", split))
    load.load_runs(rows, path)
    folders = sources.month_folders(spark, path)
    months = {month for month, _ in folders}
    assert load.merge_months(spark, path, max(months)) == len([f for f in folders if f[0] < max(months)]) > 0
    assert same(sources.read_observations(spark, path), rows)
    since, until = at("1995-03-10 00:00:00"), at("1995-04-20 00:00:00")
    bounded = sources.read_observations(spark, path, since, until)
    assert same(bounded, rows.filter((F.col("observed_at") >= F.lit(since)) & (F.col("observed_at") < F.lit(until))))
    assert load.merge_months(spark, path, max(months)) == 0
    (part,) = versions.parts(spark, f"{path}/_merged")
    for month in months - {max(months)}:
        spans = []
        for file in glob.glob(f"{part}/rows/observed_month={month}/*.parquet"):
            keys = [(r.source_offer_id, r.observed_at) for r in spark.read.parquet(file).select("source_offer_id", "observed_at").collect()]
            assert keys == sorted(keys)
            spans.append((keys[0], keys[-1]))
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    # A late run of a merged month, a crash before its merge counts, and the merge itself.
    late = typed(rows.filter("observed_at < '1995-03-01'").withColumn("scrape_run_id", F.lit("late:1")))
    load.load_runs(late, path)
    both = rows.unionByName(late)

    def crash(*given):
        sinks.write_clustered(*given)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(load, "write_clustered", crash)
        with pytest.raises(RuntimeError):
            load.merge_months(spark, path, max(months))
    assert same(sources.read_observations(spark, path), both)
    assert load.merge_months(spark, path, max(months)) > 0
    assert same(sources.read_observations(spark, path), both)
    assert {month for month, run in sources.month_folders(spark, path) if run != "late:1"} == {max(months)}
    assert same(alerts.latest_observations(sources.read_newest(spark, path, alerts.TOP_OFFERS)), alerts.latest_observations(both))


def test_ingest_pages(spark, tmp_path, models):
    pages = inputs.offer_pages(spark, models.sf_dir).drop("scrape_run_id")
    lake, rejects = str(tmp_path / "lake"), str(tmp_path / "rejects")
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(html):
        reads.add(1)
        return html

    load.ingest_pages(pages.withColumn("html", counted.asNondeterministic()("html")), "run-7", lake, rejects)
    assert reads.value == pages.count()
    stored = sources.read_observations(spark, lake).count()
    rejected = spark.read.parquet(rejects)
    assert stored > 0 and rejected.count() > 0 and stored + rejected.count() == pages.count()
    assert [r.scrape_run_id for r in load.list_runs(sources.read_observations(spark, lake)).collect()] == ["run-7"]


def test_daily_build(spark, tmp_path, obs, raw_rates, models):
    raw, rate_path, out, extracts = (str(tmp_path / n) for n in ("raw", "rates", "out", "extracts"))
    load.load_runs(obs, raw)
    raw_rates.write.parquet(rate_path)
    built = daily.build_daily(spark, raw, rate_path, out, money_scale=2)
    assert sorted(os.listdir(out)) == sorted(daily.ORDER_KEYS)
    dim = marts.dim_offers(obs, staging.latest_rates(staging.stg_rates(raw_rates)))
    assert same(built["dim__offers"], dim)
    assert same(built["fct__offer_observations"], marts.fct_offer_observations(obs))
    assert same(built["rpt__mileage_vs_price"], reports.rpt_mileage_vs_price(dim))
    assert same(built["rpt__price_distribution_by_vehicle"], reports.rpt_price_distribution(dim))
    assert same(built["rpt__brand_inventory"], models.brand())
    assert same(built["rpt__marketplace_overview"], models.overview())
    assert same(spark.table("stg__currency_rates"), built["stg__currency_rates"])
    daily.write_extracts(built, extracts)
    assert same(spark.read.parquet(f"{extracts}/rpt__fuel_type"), models.fuel())
    # A second build replaces, it does not append.
    daily.build_daily(spark, raw, rate_path, out)
    assert same(sinks.read_back(spark, f"{out}/dim__offers"), dim)


def test_failing_check_stops_the_build(spark, tmp_path):
    raw, rate_path, out = (str(tmp_path / n) for n in ("raw", "rates", "out"))
    load.load_runs(observations(spark, {}), raw)
    rates(spark, ("2024-01-01", "GBP", "PLN", "5", "2024-01-01 00:00:00")).write.parquet(rate_path)
    with pytest.raises(quality.CheckFailed, match="stg__currency_rates: price_currency accepted_values: 1"):
        daily.build_daily(spark, raw, rate_path, out)
    assert not os.path.exists(out)


def test_only_batches_with_pending_runs_are_listed(spark, tmp_path, monkeypatch):
    """100,000 runs are in the manifest and all but a few in the ledger. The folders of the others
    do not exist, and listing or reading any would fail."""
    lake, warehouse, ledger = (str(tmp_path / n) for n in ("lake", "warehouse", "ledger"))
    runs = spark.range(100_000).select(F.concat(F.lit("run-"), "id").alias("scrape_run_id"), (F.col("id") % 500).cast("string").alias("batch"), F.lit(7).cast("long").alias("rows"))
    runs.coalesce(1).write.parquet(f"{lake}/_manifest/part=old")
    runs.select("scrape_run_id", F.lit(NOW).alias("loaded_at"), F.col("rows").alias("rows_loaded")).write.parquet(ledger)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 0
    sinks.append_observations(observations(spark, {"scrape_run_id": "new:1"}, {"scrape_run_id": "run-17"}, {"scrape_run_id": "new 2%"}), lake)
    sinks.append_observations(observations(spark, {"scrape_run_id": "new:1", "source_offer_id": "other"}), lake)
    listed = []
    whole = sources.live_batches

    def seen(session, path, keys, folders=None):
        listed.extend(folders or [path])
        return whole(session, path, keys, folders)

    monkeypatch.setattr(load, "live_batches", seen)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 3
    assert len(listed) == 2 and all("/batch=" in folder for folder in listed)
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 0
    got = sources.read_observations(spark, warehouse)
    assert sorted((r.scrape_run_id, r.source_offer_id) for r in got.collect()) == sorted([("new:1", observation()["source_offer_id"]), ("new:1", "other"), ("new 2%", observation()["source_offer_id"])])
    sinks.compact_manifest(spark, lake)
    assert len(glob.glob(f"{lake}/_manifest/*")) == 1
    assert sources.read_manifest(spark, lake).count() == 100_004
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == 0


def test_batch_without_manifest_is_not_read(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    sinks.append_observations(observations(spark, {"scrape_run_id": "a"}), lake)

    def crash(written):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "manifest_rows", crash)
        with pytest.raises(RuntimeError):
            sinks.append_observations(observations(spark, {"scrape_run_id": "b"}), lake)
    sinks.append_observations(observations(spark), lake)
    assert [r.scrape_run_id for r in sources.read_observations(spark, lake).collect()] == ["a"]
    assert load.load_pending(spark, lake, str(tmp_path / "w"), str(tmp_path / "l"), NOW) == 1
    sinks.append_observations(observations(spark, {"scrape_run_id": "b"}), lake)
    assert load.load_pending(spark, lake, str(tmp_path / "w"), str(tmp_path / "l"), NOW) == 1


def test_lake_without_manifest(spark, tmp_path):
    lake = str(tmp_path / "lake")
    rows = observations(spark, {"scrape_run_id": "a"}, {"scrape_run_id": "b"})
    rows.write.partitionBy("scrape_run_id").parquet(lake)
    for expected in (2, 0):
        assert load.load_pending(spark, lake, str(tmp_path / "w"), str(tmp_path / "l"), NOW) == expected


def test_plan_does_not_grow_with_merged_runs(spark, tmp_path):
    sizes = []
    for n in (3, 300):
        path = str(tmp_path / f"raw{n}")
        rows = spark.createDataFrame(observations(spark, {}).rdd.flatMap(lambda r, n=n: [(*r[:-1], f"run-{i}") for i in range(n)]), OBSERVATIONS)
        load.load_runs(rows, path)
        assert load.merge_months(spark, path, "9999") == n
        load.load_runs(rows.limit(1).withColumn("scrape_run_id", F.lit("late")), path)
        read = sources.read_observations(spark, path)
        assert read.count() == n + 1
        sizes.append(len(re.sub(r"\S*/raw\d+\S*", "", read._jdf.queryExecution().analyzed().toString())))
    assert abs(sizes[0] - sizes[1]) < 50


def test_run_is_not_doubled_by_a_merge_between_crash_and_retry(spark, tmp_path, obs, monkeypatch):
    lake, warehouse, ledger = (str(tmp_path / n) for n in ("lake", "warehouse", "ledger"))
    rows = obs.filter("observed_at < '1995-03-01'")
    sinks.append_observations(rows, lake)
    with monkeypatch.context() as patched:
        patched.setattr(load, "ledger_rows", lambda rows, now: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load.load_pending(spark, lake, warehouse, ledger, NOW)
    assert load.merge_months(spark, warehouse, "199502") > 0
    assert load.load_pending(spark, lake, warehouse, ledger, NOW) == rows.count()
    assert same(sources.read_observations(spark, warehouse), rows)


def test_ingests_side_by_side(spark, tmp_path, models):
    import threading

    pages = inputs.offer_pages(spark, models.sf_dir).drop("scrape_run_id").limit(60).cache()
    lake, rejects = str(tmp_path / "lake"), str(tmp_path / "rejects")
    threads = [threading.Thread(target=load.ingest_pages, args=(pages, f"run-{i}", lake, rejects)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    stored = sources.read_observations(spark, lake).groupBy("scrape_run_id").count().collect()
    rejected = {r.scrape_run_id: r["count"] for r in spark.read.parquet(rejects).groupBy("scrape_run_id").count().collect()}
    assert len(stored) == 3 and all(r["count"] + rejected.get(r.scrape_run_id, 0) == pages.count() for r in stored)
    assert os.listdir(f"{rejects}/_parsed") == []
