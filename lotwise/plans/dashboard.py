"""Report extracts and the dashboard's page queries on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What each extract reads and how it is ordered.
EXTRACTS: dict[str, dict] = {
    "fct__offer_observations": {
        "columns": [
            "offer_key",
            "observed_at",
            "price_amount",
            "price_currency",
            "mileage_km",
            "scrape_run_id",
        ],
    },
    "rpt__brand_inventory": {
        "columns": ["brand", "total_offers", "inventory_share"],
        "order": [("total_offers", "desc"), ("brand", "asc")],
    },
    "rpt__fuel_type": {
        "columns": ["fuel_type", "total_offers", "fuel_share"],
        "order": [("total_offers", "desc"), ("fuel_type", "asc")],
    },
    "rpt__marketplace_overview": {
        "columns": [
            "observation_date",
            "current_offer_count",
            "new_offer_count",
            "cumulative_offer_count",
            "observation_count",
            "distinct_offer_count",
            "average_price_amount",
        ],
        "order": [("observation_date", "asc")],
    },
    "rpt__mileage_vs_price": {
        "columns": [
            "offer_key",
            "url",
            "title",
            "brand",
            "vehicle_model",
            "model_year",
            "fuel_type",
            "transmission",
            "mileage_km",
            "price_amount",
            "price_currency",
            "last_observed_at",
        ],
    },
    "rpt__price_distribution_by_vehicle": {
        "columns": [
            "brand",
            "vehicle_model",
            "model_year",
            "price_currency",
            "offer_count",
            "minimum_price_amount",
            "median_price_amount",
            "maximum_price_amount",
        ],
    },
}
TOP_BRANDS = 10
LATEST_OFFERS = 1000
TOP_VEHICLES = 15
BAND_KM = 25_000


def extract(name: str, mart: DataFrame) -> DataFrame:
    """A mart as the dashboard reads it. Ties in an order are broken by the key."""
    spec = EXTRACTS[name]
    rows = mart.select(*spec["columns"])
    order = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in spec.get("order", [])]
    return rows.orderBy(*order) if order else rows


def overview(marketplace: DataFrame) -> DataFrame:
    return marketplace.orderBy("observation_date")


def current_metrics(marketplace: DataFrame) -> DataFrame:
    """The newest day."""
    return (
        marketplace.select(
            "current_offer_count",
            "average_price_amount",
            "observation_count",
            "distinct_offer_count",
            "new_offer_count",
            "observation_date",
        )
        .orderBy(F.desc("observation_date"))
        .limit(1)
    )


def brands(inventory: DataFrame) -> DataFrame:
    return inventory.orderBy(F.desc("total_offers"), "brand")


def top_brands(inventory: DataFrame) -> DataFrame:
    return brands(inventory).limit(TOP_BRANDS)


def fuels(fuel: DataFrame) -> DataFrame:
    return fuel.orderBy(F.desc("total_offers"), "fuel_type")


def latest_offers(mileage_price: DataFrame) -> DataFrame:
    """Newest 1,000 offers with a usable mileage and price, ties by key."""
    usable = mileage_price.filter((F.col("mileage_km") >= 0) & (F.col("price_amount") > 0))
    return usable.orderBy(F.desc("last_observed_at"), "offer_key").limit(LATEST_OFFERS)


def mileage_bands(mileage_price: DataFrame) -> DataFrame:
    """Median price per brand and mileage band over ``latest_offers``."""
    middle = F.floor(F.col("mileage_km") / float(BAND_KM)) * BAND_KM + BAND_KM // 2
    return (
        latest_offers(mileage_price)
        .groupBy("brand", middle.cast("int").alias("mileage_band_midpoint"))
        # At most 1,000 rows in all, so the built-in median may buffer them.
        .agg(F.median("price_amount").alias("median_price_amount"), F.count("*").alias("offer_count"))
        .orderBy("mileage_band_midpoint", "brand")
    )


def vehicle_prices(distribution: DataFrame) -> DataFrame:
    """Largest 15 vehicle groups, ties by median, then by group."""
    return distribution.orderBy(
        F.desc("offer_count"),
        F.desc("median_price_amount"),
        "brand",
        "vehicle_model",
        "model_year",
        "price_currency",
    ).limit(TOP_VEHICLES)
