from pyspark.sql import functions as F

from lotwise.plans import dashboard, marts, reports
from tests.samples import at, observations


def _mileage(spark, rows):
    return reports.rpt_mileage_vs_price(marts.dim_offers(observations(spark, *rows)))


def test_mileage_bands(spark):
    rows = [
        {"source_offer_id": str(i), "mileage_km": km, "price_amount": price}
        for i, (km, price) in enumerate([(0, 1.0), (24_999, 4.0), (25_000, 7.0), (-1, 9.0), (10, 0.0), (None, 5.0)])
    ]
    bands = dashboard.mileage_bands(_mileage(spark, rows)).collect()
    assert [tuple(b) for b in bands] == [("b", 12_500, 2.5, 2), ("b", 37_500, 7.0, 1)]


def test_bands_are_over_the_latest_offers_only(spark):
    rows = [
        {"source_offer_id": f"{i:05}", "observed_at": at("2024-01-01 00:00:00"), "price_amount": 1.0 + i}
        for i in range(1005)
    ]
    rows.append({"source_offer_id": "z", "observed_at": at("2024-02-01 00:00:00"), "price_amount": 5.0})
    latest = dashboard.latest_offers(_mileage(spark, rows)).collect()
    assert len(latest) == 1000 and latest[0].offer_key == "z" and latest[-1].offer_key == "00998"
    assert sum(b.offer_count for b in dashboard.mileage_bands(_mileage(spark, rows)).collect()) == 1000


def test_orders(models):
    brands = [(-r.total_offers, r.brand) for r in dashboard.brands(models.brand()).collect()]
    assert brands == sorted(brands)
    assert [(-r.total_offers, r.brand) for r in dashboard.top_brands(models.brand()).collect()] == brands[:10]
    fuels = [(-r.total_offers, r.fuel_type) for r in dashboard.fuels(models.fuel()).collect()]
    assert fuels == sorted(fuels)
    days = [r.observation_date for r in dashboard.overview(models.overview()).collect()]
    assert days == sorted(days)
    assert dashboard.current_metrics(models.overview()).first().observation_date == days[-1]
    vehicles = dashboard.vehicle_prices(models.distribution()).collect()
    keys = [(-r.offer_count, -r.median_price_amount) for r in vehicles]
    assert len(vehicles) == 15 and keys == sorted(keys)
    bands = [(r.mileage_band_midpoint, r.brand) for r in dashboard.mileage_bands(models.mileage()).collect()]
    assert bands == sorted(bands)


def test_shares_add_up(models):
    total = models.brand().agg(F.sum("inventory_share")).first()[0]
    assert abs(total - 1) < 1e-9


def test_extract_order(models):
    rows = dashboard.extract("rpt__fuel_type", models.fuel()).collect()
    assert [r.total_offers for r in rows] == sorted((r.total_offers for r in rows), reverse=True)
    assert rows[0].asDict().keys() == {"fuel_type", "total_offers", "fuel_share"}
