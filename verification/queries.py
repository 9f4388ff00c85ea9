"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.plans import alerts, dashboard, load, marts, quality, reports, staging
from lotwise.schemas import RATE_KEYS
from lotwise.sinks.tables import compact_latest, manifest_rows, with_month
from lotwise.sources import listings, offer_pages, rate_payloads
from lotwise.sources.tables import live_runs, read_run
from verification import inputs

# Prices of the given tables have two decimals.
MONEY_SCALE = 2
ONE_RUN = "run-1995-06"


class Models:
    """The models over one scale factor; each is built when asked for, all lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cache
    def obs(self) -> DataFrame:
        return inputs.observations(self.spark, self.sf_dir)

    @cache
    def rates(self) -> DataFrame:
        return inputs.rates(self.spark, self.sf_dir)

    @cache
    def latest(self) -> DataFrame:
        return staging.latest_rates(staging.upper_rates(self.rates()))

    @cache
    def stg(self) -> DataFrame:
        return staging.stg_observations(self.obs())

    @cache
    def fct(self) -> DataFrame:
        return marts.fct_offer_observations(self.stg())

    @cache
    def dim(self) -> DataFrame:
        return marts.dim_offers(self.stg(), self.latest())

    @cache
    def daily(self) -> DataFrame:
        return marts.agg_daily(self.fct(), MONEY_SCALE)

    def brand(self) -> DataFrame:
        return reports.rpt_brand_inventory(marts.agg_by_brand(self.dim()))

    def fuel(self) -> DataFrame:
        return reports.rpt_fuel_type(marts.agg_by_fuel(self.dim()))

    def overview(self) -> DataFrame:
        return reports.rpt_marketplace_overview(self.dim(), self.daily())

    def mileage(self) -> DataFrame:
        return reports.rpt_mileage_vs_price(self.dim())

    def distribution(self) -> DataFrame:
        return reports.rpt_price_distribution(self.dim())

    def table(self, name: str) -> DataFrame:
        return {
            "offers_observations": self.obs,
            "currency_rates": self.rates,
            "stg__currency_rates": lambda: staging.stg_rates(self.rates()),
            "dim__offers": self.dim,
            "fct__offer_observations": self.fct,
            "agg__offers_by_brand": lambda: marts.agg_by_brand(self.dim()),
            "agg__offers_by_fuel_type": lambda: marts.agg_by_fuel(self.dim()),
            "agg__daily_offer_observations": self.daily,
            "rpt__marketplace_overview": self.overview,
            "rpt__mileage_vs_price": self.mileage,
            "rpt__price_distribution_by_vehicle": self.distribution,
        }[name]()


def _checks(m: Models, kind: str, extra: list[quality.Check]) -> DataFrame:
    """The declared checks of a kind, which pass, and some that find failures."""
    checks = [check for check in quality.CHECKS if check.kind == kind] + extra
    names = {check.model for check in checks} | {check.parent for check in checks if check.parent}
    return quality.run_checks({name: m.table(name) for name in names}, checks)


def _parsed_listings(m: Models) -> DataFrame:
    return listings.parse_listings(inputs.listings(m.spark, m.sf_dir))


def _listing_urls(m: Models) -> DataFrame:
    return listings.listing_urls(_parsed_listings(m), ["target", "page"])


def _listing_pages(m: Models) -> tuple[DataFrame, DataFrame]:
    parsed = _parsed_listings(m).withColumnRenamed("page", "listing_page")
    return listings.listing_pages(parsed, ["target", "listing_page"])


def _pages(m: Models) -> tuple[DataFrame, DataFrame]:
    return offer_pages.pages_to_observations(inputs.offer_pages(m.spark, m.sf_dir), F.col("scrape_run_id"))


def _typed_nodes(m: Models) -> DataFrame:
    return _parsed_listings(m).select(
        "target",
        "page",
        F.col("reject_reason").isNull().alias("found"),
        F.col("search.totalCount").cast("bigint").alias("total_count"),
        F.size(listings.edge_list(F.col("search.edges"))).alias("edge_count"),
    )


def _pending(m: Models) -> DataFrame:
    obs = m.obs()
    return load.pending_rows(obs, load.pending_runs(obs, inputs.ledger(obs)))


def _runs(m: Models) -> DataFrame:
    rows = m.obs().groupBy("scrape_run_id").agg(F.count("*").alias("rows_loaded"))
    return rows.withColumn("duration_seconds", F.col("rows_loaded") * 0.5)


def _ledger(m: Models) -> DataFrame:
    now = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    return load.ledger_rows(_pending(m), now)


def _batched(m: Models) -> DataFrame:
    """Observations in ten batches: a run may be in several."""
    return m.obs().withColumn("batch", (F.col("source_offer_id").cast("bigint") % 10).cast("string"))


def _live(m: Models) -> DataFrame:
    """What is read of the run folders after a merge of the months before a fixed one: runs from
    then on, and those that came late for a merged month."""
    stored = with_month(m.obs(), "observed_at")
    late = stored.filter(F.month("observed_at") == 6).select("observed_month", "scrape_run_id")
    return live_runs(stored, inputs.MERGED_BEFORE, late).groupBy("observed_month", "scrape_run_id").agg(F.count("*").alias("stored_rows"))


QUERIES: dict[str, Callable[[Models], DataFrame]] = {
    "s3_page_json": lambda m: offer_pages.extract_page_json(inputs.offer_pages(m.spark, m.sf_dir)).drop("html"),
    "s4_s5_offers": lambda m: _pages(m)[0],
    "s6_rejects": lambda m: _pages(m)[1],
    "s7_typed_node": _typed_nodes,
    "s8_urls": _listing_urls,
    "s8_edge_rejects": lambda m: listings.listing_edge_rejects(_parsed_listings(m), ["target", "page"]),
    "s9_pages": lambda m: _listing_pages(m)[0],
    "s9_page_rejects": lambda m: _listing_pages(m)[1],
    "s10_first_seen": lambda m: listings.distinct_urls(_listing_urls(m), ["target", "page", "edge_pos"]),
    "s11_rates": lambda m: rate_payloads.parse_rates(inputs.rate_payloads(m.spark, m.sf_dir))[0],
    "s12_rate_rejects": lambda m: rate_payloads.parse_rates(inputs.rate_payloads(m.spark, m.sf_dir))[1],
    "s13_run": lambda m: read_run(m.obs(), ONE_RUN),
    "k3_compact": lambda m: compact_latest(m.rates(), RATE_KEYS, "fetched_at"),
    "l1_runs": lambda m: load.list_runs(m.obs()),
    "l2_pending": lambda m: load.pending_runs(m.obs(), inputs.ledger(m.obs())),
    "l3_pending_rows": _pending,
    "l3_manifest": lambda m: load.pending_manifest(manifest_rows(_batched(m)), inputs.ledger(m.obs())),
    "s1_k2_live_months": _live,
    "l4_ledger": lambda m: _ledger(m).drop("loaded_at"),
    "l5_total": lambda m: load.total_loaded(_ledger(m)),
    "t1_stg_obs": lambda m: m.stg(),
    "t3_stg_rates": lambda m: staging.stg_rates(m.rates()),
    "t4_latest": lambda m: staging.latest_rates(staging.stg_rates(m.rates())),
    "t5_t7_normalized": lambda m: staging.int_exchange_rates(m.stg(), m.latest()),
    "m1_fct": lambda m: m.fct(),
    "m2_latest": lambda m: marts.latest_state(staging.int_exchange_rates(m.stg(), m.latest())),
    "m3_history": lambda m: marts.offer_history(m.stg()),
    "m4_dim": lambda m: m.dim(),
    "m5_daily": lambda m: m.daily(),
    "m6_brand": lambda m: marts.agg_by_brand(m.dim()),
    "m7_fuel": lambda m: marts.agg_by_fuel(m.dim()),
    "r1_brand_share": lambda m: m.brand(),
    "r2_fuel_share": lambda m: m.fuel(),
    "r4_new_by_day": lambda m: reports.new_offers_by_day(m.dim()),
    "r8_overview": lambda m: m.overview(),
    "r9_mileage": lambda m: m.mileage(),
    "r10_distribution": lambda m: m.distribution(),
    "k6_fct": lambda m: dashboard.extract("fct__offer_observations", m.fct()),
    "k6_brand": lambda m: dashboard.extract("rpt__brand_inventory", m.brand()),
    "k6_fuel": lambda m: dashboard.extract("rpt__fuel_type", m.fuel()),
    "k6_overview": lambda m: dashboard.extract("rpt__marketplace_overview", m.overview()),
    "k6_mileage": lambda m: dashboard.extract("rpt__mileage_vs_price", m.mileage()),
    "k6_distribution": lambda m: dashboard.extract("rpt__price_distribution_by_vehicle", m.distribution()),
    "q1_overview": lambda m: dashboard.overview(m.overview()),
    "q2_metrics": lambda m: dashboard.current_metrics(m.overview()),
    "q3_brands": lambda m: dashboard.brands(m.brand()),
    "q4_top_brands": lambda m: dashboard.top_brands(m.brand()),
    "q5_fuels": lambda m: dashboard.fuels(m.fuel()),
    "q6_latest_offers": lambda m: dashboard.latest_offers(m.mileage()),
    "q7_bands": lambda m: dashboard.mileage_bands(m.mileage()),
    "q8_vehicles": lambda m: dashboard.vehicle_prices(m.distribution()),
    "d1_latest": lambda m: alerts.latest_observations(m.obs()),
    "d2_latest_in_run": lambda m: alerts.latest_in_runs(m.obs()),
    "d3_digest": lambda m: alerts.latest_digest(alerts.latest_observations(m.obs())),
    "d4_digest": lambda m: alerts.run_digests(_runs(m), alerts.latest_in_runs(m.obs())),
    "c1_not_null": lambda m: _checks(
        m,
        quality.NOT_NULL,
        [
            quality.Check("offers_observations", column, quality.NOT_NULL)
            for column in ("brand", "model", "year", "mileage_km", "transmission", "price_amount", "price_currency")
        ],
    ),
    "c2_unique": lambda m: _checks(
        m, quality.UNIQUE, [quality.Check("fct__offer_observations", "offer_key", quality.UNIQUE)]
    ),
    "c3_accepted": lambda m: _checks(
        m,
        quality.ACCEPTED,
        [quality.Check("offers_observations", "price_currency", quality.ACCEPTED, values=("EUR", "PLN"))],
    ),
    "c4_relationships": lambda m: _checks(
        m,
        quality.RELATIONSHIPS,
        [
            quality.Check(
                "fct__offer_observations",
                "offer_key",
                quality.RELATIONSHIPS,
                parent="rpt__mileage_vs_price",
                parent_column="offer_key",
            )
        ],
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Models(spark, sf_dir))

    return {name: bound(build) for name, build in QUERIES.items()}
