"""Small hand-written tables."""

import datetime as dt

from lotwise.schemas import OBSERVATIONS, RATES


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


DEFAULTS = {
    "source_offer_id": "1",
    "url": "https://market.example/offer/1",
    "title": "offer",
    "brand": "b",
    "model": "m",
    "year": 2010,
    "mileage_km": 1000,
    "fuel_type": "petrol",
    "transmission": "manual",
    "price_amount": 100.0,
    "price_currency": "PLN",
    "observed_at": at("2024-01-01 10:00:00"),
    "scrape_run_id": "run-1",
}


def observation(**values):
    return {**DEFAULTS, **values}


def observations(spark, *rows):
    names = OBSERVATIONS.fieldNames()
    return spark.createDataFrame([tuple(observation(**row)[n] for n in names) for row in rows], OBSERVATIONS)


def rates(spark, *rows):
    """Rows of (date, base, quote, rate, fetched_at)."""
    from decimal import Decimal

    return spark.createDataFrame(
        [
            (dt.date.fromisoformat(date), base, quote, Decimal(rate), "NBP", "1/A/NBP", at(fetched))
            for date, base, quote, rate, fetched in rows
        ],
        RATES,
    )
