"""Fact, dimension and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.latest import latest_per_key, near_keys
from lotwise.plans.staging import normalize_prices
from lotwise.schemas import OBSERVATION_COLUMNS

OFFER_ATTRIBUTES = [
    "url",
    "title",
    "brand",
    "model",
    "year",
    "mileage_km",
    "fuel_type",
    "transmission",
    "price_amount",
    "price_currency",
]
UNKNOWN = "unknown"


def fct_offer_observations(observations: DataFrame) -> DataFrame:
    """One row per observed offer state; prices as listed, not converted."""
    return observations.select(
        F.col("source_offer_id").alias("offer_key"),
        "observed_at",
        "price_amount",
        "price_currency",
        "mileage_km",
        "scrape_run_id",
    )


def latest_state(observations: DataFrame) -> DataFrame:
    """Newest observation per offer, whole, so a NULL price of it stays NULL."""
    rows = near_keys(observations.select(*OBSERVATION_COLUMNS), ["source_offer_id"])
    return latest_per_key(rows, ["source_offer_id"], ["observed_at", "scrape_run_id"])


def offer_history(observations: DataFrame) -> DataFrame:
    return observations.groupBy("source_offer_id").agg(
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
        F.count("*").alias("observation_count"),
    )


def offers(observations: DataFrame) -> DataFrame:
    """``latest_state`` and ``offer_history`` in one pass over the observations. Readers of
    some columns only share the shuffle of the rows, which has them all."""
    newest = F.max(F.struct("observed_at", "scrape_run_id", *OFFER_ATTRIBUTES))
    return (
        near_keys(observations.select(*OBSERVATION_COLUMNS), ["source_offer_id"])
        .groupBy("source_offer_id")
        .agg(
            newest.alias("newest"),
            F.min("observed_at").alias("first_observed_at"),
            F.count("*").alias("observation_count"),
        )
        .select(
            F.col("source_offer_id"),
            *[F.col(f"newest.{c}").alias(c) for c in OFFER_ATTRIBUTES],
            F.col("newest.observed_at").alias("observed_at"),
            "first_observed_at",
            "observation_count",
        )
    )


def dim_offers(observations: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """One row per offer: newest state and history.

    Give either normalized observations, or plain ones and the latest rates. The second
    converts one price per offer instead of one per observation, with the same result.
    """
    state = offers(observations)
    if rates is not None:
        state = normalize_prices(state, rates)
    return state.select(
        F.col("source_offer_id").alias("offer_key"),
        *OFFER_ATTRIBUTES,
        "first_observed_at",
        F.col("observed_at").alias("last_observed_at"),
        "observation_count",
    )


def agg_daily(fact: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Observations, distinct offers and mean listed price per UTC day, currencies mixed.

    The distinct count is exact: the first shuffle is on (day, offer), so a busy day is
    spread. ``money_scale`` sums prices as decimals with that many places, which makes the
    mean independent of row order to the last digit. A day with a price that is not finite
    or too large for a decimal has the mean that it has without ``money_scale``.
    """
    price = F.col("price_amount")
    mean = F.avg(price)
    if money_scale is not None:
        money = price.try_cast(f"decimal(18,{money_scale})")
        exact = F.sum(money).cast("double") / F.nullif(F.count(price), F.lit(0))
        mean = F.when(F.count(money) == F.count(price), exact).otherwise(mean)
    return fact.groupBy(F.to_date("observed_at").alias("observation_date")).agg(
        F.count("*").alias("observation_count"),
        F.countDistinct("offer_key").alias("distinct_offer_count"),
        mean.alias("average_price_amount"),
    )


def agg_by_brand(dim: DataFrame) -> DataFrame:
    return _offers_by(dim, "brand")


def agg_by_fuel(dim: DataFrame) -> DataFrame:
    return _offers_by(dim, "fuel_type")


def _offers_by(dim: DataFrame, column: str) -> DataFrame:
    """Offers per value; a missing value and the literal 'unknown' are one group."""
    value = F.coalesce(F.col(column), F.lit(UNKNOWN)).alias(column)
    return dim.select(value).groupBy(column).agg(F.count("*").alias("offer_count"))
