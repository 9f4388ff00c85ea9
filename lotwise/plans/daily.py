"""The daily build: every model in lineage order, each checked before its children."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.plans import marts, reports, staging
from lotwise.plans.dashboard import EXTRACTS, extract
from lotwise.plans.quality import require_passing
from lotwise.sinks.tables import materialize, read_back, register_views
from lotwise.sources.tables import read_observations, read_rates

# Order key of each stored model; where a key has many equal values, further
# columns follow, so that range partitioning can split it.
ORDER_KEYS = {
    "dim__offers": ["offer_key"],
    "fct__offer_observations": ["offer_key", "observed_at"],
    "agg__daily_offer_observations": ["observation_date"],
    "agg__offers_by_brand": ["brand"],
    "agg__offers_by_fuel_type": ["fuel_type"],
    "rpt__brand_inventory": ["brand"],
    "rpt__fuel_type": ["fuel_type"],
    "rpt__marketplace_overview": ["observation_date"],
    "rpt__mileage_vs_price": ["brand", "vehicle_model", "model_year", "offer_key"],
    "rpt__price_distribution_by_vehicle": [
        "offer_count",
        "brand",
        "vehicle_model",
        "model_year",
        "price_currency",
    ],
}


def build_daily(
    spark: SparkSession, observations: str, rates: str, out: str, money_scale: int | None = None
) -> dict[str, DataFrame]:
    """Rebuild all models under ``out`` from the raw tables at ``observations`` and
    ``rates``; gives the models, read from what was written. ``money_scale`` is that of
    ``marts.agg_daily``.

    A failing check raises and nothing that depends on the model is built.
    """
    tables: dict[str, DataFrame] = {
        "offers_observations": read_observations(spark, observations),
        "currency_rates": read_rates(spark, rates),
    }
    for source in list(tables):
        require_passing(tables, source)

    def view(name: str, df: DataFrame) -> DataFrame:
        register_views({name: df})
        tables[name] = df
        require_passing(tables, name)
        return df

    def table(name: str, df: DataFrame) -> DataFrame:
        path = f"{out}/{name}"
        materialize(df, path, ORDER_KEYS[name])
        tables[name] = read_back(spark, path)
        require_passing(tables, name)
        return tables[name]

    observed = view("stg_raw__offers_observations", staging.stg_observations(tables["offers_observations"]))
    rated = view("stg__currency_rates", staging.stg_rates(tables["currency_rates"]))
    latest = staging.latest_rates(rated)
    view("int__exchange_rates", staging.int_exchange_rates(observed, latest))

    dim = table("dim__offers", marts.dim_offers(observed, latest))
    fact = table("fct__offer_observations", marts.fct_offer_observations(observed))
    daily = table("agg__daily_offer_observations", marts.agg_daily(fact, money_scale))
    by_brand = table("agg__offers_by_brand", marts.agg_by_brand(dim))
    by_fuel = table("agg__offers_by_fuel_type", marts.agg_by_fuel(dim))
    table("rpt__brand_inventory", reports.rpt_brand_inventory(by_brand))
    table("rpt__fuel_type", reports.rpt_fuel_type(by_fuel))
    table("rpt__marketplace_overview", reports.rpt_marketplace_overview(dim, daily))
    table("rpt__mileage_vs_price", reports.rpt_mileage_vs_price(dim))
    table("rpt__price_distribution_by_vehicle", reports.rpt_price_distribution(dim))
    return tables


def write_extracts(tables: dict[str, DataFrame], out: str) -> None:
    """Write the dashboard's extracts of the built models."""
    for name in EXTRACTS:
        extract(name, tables[name]).write.mode("overwrite").parquet(f"{out}/{name}")
