"""Staging views and currency normalization."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.latest import latest_per_key
from lotwise.operators.lookup import MAX_BROADCAST_ROWS, lookup_join
from lotwise.schemas import OBSERVATION_COLUMNS

# Fixed value: currency that prices are normalized to.
TARGET_CURRENCY = "PLN"


def stg_observations(raw: DataFrame) -> DataFrame:
    return raw.select(*OBSERVATION_COLUMNS)


def upper_rates(raw: DataFrame) -> DataFrame:
    """Rates with upper-case codes, the base currency under its staging name."""
    return raw.select(
        "effective_date",
        F.upper("base_currency").alias("price_currency"),
        F.upper("quote_currency").alias("quote_currency"),
        "rate_to_pln",
        "provider",
        "source_table",
        "fetched_at",
    )


def stg_rates(raw: DataFrame) -> DataFrame:
    """Last fetched rate per date and currency pair; codes that differ only in case are one
    pair, the provider is not part of the key."""
    return latest_per_key(upper_rates(raw), ["effective_date", "price_currency", "quote_currency"], ["fetched_at"])


def latest_rates(rates: DataFrame) -> DataFrame:
    """Newest rate to the target currency per currency. Takes ``stg_rates`` or, with the
    same result and one shuffle less, ``upper_rates``: the newest (date, fetch) of a
    currency is also the last fetch of its date."""
    known = rates.filter((F.col("quote_currency") == TARGET_CURRENCY) & F.col("rate_to_pln").isNotNull())
    newest = F.max_by("rate_to_pln", F.struct("effective_date", "fetched_at"))
    return known.groupBy("price_currency").agg(newest.alias("rate_to_pln"))


def normalize_prices(
    rows: DataFrame, rates: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Price in the target currency where that is known. A price in a currency without a
    rate keeps the currency and loses the amount. ``rates`` is the latest-rate table; it is
    applied to all rows, whatever their date."""
    columns = rows.columns
    joined = lookup_join(rows, rates, "price_currency", ["source_offer_id", "observed_at"], max_broadcast_rows)
    is_target = F.col("price_currency") == TARGET_CURRENCY
    has_rate = F.col("rate_to_pln").isNotNull()
    currency = F.when(is_target | has_rate, F.lit(TARGET_CURRENCY)).otherwise(F.col("price_currency"))
    amount = F.when(is_target, F.col("price_amount")).when(
        has_rate, F.col("price_amount") * F.col("rate_to_pln").cast("double")
    )
    return joined.withColumns({"price_currency": currency, "price_amount": amount}).select(*columns)


def int_exchange_rates(observations: DataFrame, rates: DataFrame) -> DataFrame:
    """Observations with normalized prices."""
    return normalize_prices(stg_observations(observations), rates)
