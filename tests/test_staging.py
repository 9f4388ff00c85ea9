from decimal import Decimal

from lotwise.plans import staging
from tests.samples import observations, rates

RATE_ROWS = [
    ("2024-01-02", "eur", "PLN", "4.30", "2024-01-02 10:00:00"),
    ("2024-01-02", "EUR", "pln", "4.40", "2024-01-02 12:00:00"),
    ("2024-01-01", "EUR", "PLN", "9.99", "2024-01-03 10:00:00"),
    ("2024-01-02", "USD", "PLN", "3.90", "2024-01-02 10:00:00"),
    ("2024-01-05", "USD", "EUR", "0.90", "2024-01-05 10:00:00"),
]


def test_codes_that_differ_in_case_are_one_pair(spark):
    kept = staging.stg_rates(rates(spark, *RATE_ROWS)).collect()
    same_day = [r.rate_to_pln for r in kept if r.price_currency == "EUR" and str(r.effective_date) == "2024-01-02"]
    assert same_day == [Decimal("4.40000000")]
    assert len(kept) == 4


def test_newest_date_wins_before_newest_fetch(spark):
    raw = rates(spark, *RATE_ROWS)
    newest = {r.price_currency: r.rate_to_pln for r in staging.latest_rates(staging.stg_rates(raw)).collect()}
    assert newest == {"EUR": Decimal("4.40000000"), "USD": Decimal("3.90000000")}
    direct = {r.price_currency: r.rate_to_pln for r in staging.latest_rates(staging.upper_rates(raw)).collect()}
    assert direct == newest


def _prices(spark, max_broadcast_rows=1000):
    rows = observations(
        spark,
        {"source_offer_id": "gbp", "price_currency": "GBP"},
        {"source_offer_id": "none", "price_currency": None},
        {"source_offer_id": "pln"},
        {"source_offer_id": "eur", "price_currency": "EUR", "price_amount": 10.0},
        {"source_offer_id": "eur-null", "price_currency": "EUR", "price_amount": None},
    )
    latest = staging.latest_rates(staging.stg_rates(rates(spark, *RATE_ROWS)))
    priced = staging.normalize_prices(rows, latest, max_broadcast_rows)
    return {r.source_offer_id: (r.price_currency, r.price_amount) for r in priced.collect()}


def test_normalized_prices(spark):
    assert _prices(spark) == {
        "gbp": ("GBP", None),
        "none": (None, None),
        "pln": ("PLN", 100.0),
        "eur": ("PLN", 44.0),
        "eur-null": ("PLN", None),
    }


def test_lookup_too_large_to_broadcast_gives_the_same(spark, models):
    assert _prices(spark, max_broadcast_rows=1) == _prices(spark)
    stg, latest = models.stg(), models.latest()
    small = staging.normalize_prices(stg, latest)
    large = staging.normalize_prices(stg, latest, max_broadcast_rows=0)
    assert "broadcast" in small._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
