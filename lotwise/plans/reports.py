"""Report marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.operators.median import price_summary
from lotwise.plans.marts import UNKNOWN

VEHICLE = ["brand", "vehicle_model", "model_year"]


def rpt_brand_inventory(by_brand: DataFrame) -> DataFrame:
    """Largest first, ties by name."""
    return _share(by_brand, "brand", "inventory_share").orderBy(F.desc("total_offers"), "brand")


def rpt_fuel_type(by_fuel: DataFrame) -> DataFrame:
    return _share(by_fuel, "fuel_type", "fuel_share")


def _share(counts: DataFrame, key: str, share: str) -> DataFrame:
    total = counts.agg(F.sum("offer_count")).scalar()
    return counts.select(
        key,
        F.col("offer_count").alias("total_offers"),
        (F.col("offer_count") / F.nullif(total, F.lit(0))).alias(share),
    )


def new_offers_by_day(dim: DataFrame) -> DataFrame:
    day = F.to_date("first_observed_at").alias("observation_date")
    return dim.groupBy(day).agg(F.count("*").alias("new_offer_count"))


def rpt_marketplace_overview(dim: DataFrame, daily: DataFrame) -> DataFrame:
    """Per day with activity: current inventory, new offers, running total and activity."""
    new = new_offers_by_day(dim)
    # Every offer is new on one day, so the sum is the number of offers.
    current = F.coalesce(new.agg(F.sum("new_offer_count")).scalar(), F.lit(0).cast("bigint"))
    # Rows are days here, tens of thousands at most, so one window over all is enough.
    so_far = Window.orderBy("observation_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = daily.join(new, "observation_date", "left").withColumn(
        "new_offer_count", F.coalesce("new_offer_count", F.lit(0).cast("bigint"))
    )
    return days.select(
        "observation_date",
        current.alias("current_offer_count"),
        "new_offer_count",
        F.sum("new_offer_count").over(so_far).alias("cumulative_offer_count"),
        "observation_count",
        "distinct_offer_count",
        "average_price_amount",
    )


def _vehicle(dim: DataFrame) -> DataFrame:
    """Brand, model and year without NULLs."""
    return dim.withColumns(
        {
            "brand": F.coalesce("brand", F.lit(UNKNOWN)),
            "vehicle_model": F.coalesce("model", F.lit(UNKNOWN)),
            "model_year": F.coalesce("year", F.lit(0)),
        }
    )


def rpt_mileage_vs_price(dim: DataFrame) -> DataFrame:
    priced = dim.filter(F.col("mileage_km").isNotNull() & F.col("price_amount").isNotNull())
    return _vehicle(priced).select(
        "offer_key",
        "url",
        "title",
        *VEHICLE,
        "fuel_type",
        "transmission",
        "mileage_km",
        "price_amount",
        "price_currency",
        "last_observed_at",
    )


def rpt_price_distribution(dim: DataFrame) -> DataFrame:
    """Count, minimum, exact median and maximum price per vehicle and currency."""
    priced = dim.filter(F.col("price_amount").isNotNull() & F.col("price_currency").isNotNull())
    summary = price_summary(_vehicle(priced), [*VEHICLE, "price_currency"], "price_amount")
    return summary.select(
        *VEHICLE,
        "price_currency",
        F.col("count").alias("offer_count"),
        F.col("minimum").alias("minimum_price_amount"),
        F.col("median").alias("median_price_amount"),
        F.col("maximum").alias("maximum_price_amount"),
    )
