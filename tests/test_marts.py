from lotwise.plans import marts, reports, staging
from tests.samples import at, observations


def test_latest_state_keeps_a_null_price(spark):
    rows = observations(
        spark,
        {"observed_at": at("2024-01-01 10:00:00"), "price_amount": 5.0},
        {"observed_at": at("2024-01-03 10:00:00"), "price_amount": None, "brand": None, "title": "newest"},
        {"observed_at": at("2024-01-02 10:00:00"), "price_amount": 7.0},
    )
    (offer,) = marts.dim_offers(rows).collect()
    assert (offer.title, offer.price_amount, offer.brand, offer.observation_count) == ("newest", None, None, 3)
    assert (offer.last_observed_at - offer.first_observed_at).days == 2


def test_one_pass_equals_latest_joined_with_history(models):
    normalized = staging.int_exchange_rates(models.stg(), models.latest())
    joined = (
        marts.latest_state(normalized)
        .join(marts.offer_history(normalized), "source_offer_id")
        .withColumnRenamed("source_offer_id", "offer_key")
    )
    after, before = models.dim(), marts.dim_offers(normalized)
    expected = joined.select(*after.columns)
    for dim in (after, before):
        assert dim.exceptAll(expected).isEmpty() and expected.exceptAll(dim).isEmpty()


def test_ties_do_not_depend_on_row_order(spark):
    rows = [{"scrape_run_id": f"run-{i}", "title": f"title {i}"} for i in range(20)]
    forward = marts.dim_offers(observations(spark, *rows)).collect()
    backward = marts.dim_offers(observations(spark, *rows[::-1])).collect()
    assert forward == backward and forward[0].title == "title 9"


def test_missing_and_literal_unknown_are_one_group(spark):
    rows = [
        {"source_offer_id": "1", "brand": None, "fuel_type": None},
        {"source_offer_id": "2", "brand": "unknown", "fuel_type": "unknown"},
    ]
    dim = marts.dim_offers(observations(spark, *rows))
    assert [tuple(r) for r in marts.agg_by_brand(dim).collect()] == [("unknown", 2)]
    assert [tuple(r) for r in marts.agg_by_fuel(dim).collect()] == [("unknown", 2)]


def test_daily_average_ignores_nulls_and_mixes_currencies(spark):
    rows = observations(
        spark,
        {"price_amount": 10.0},
        {"price_amount": 20.0, "price_currency": "EUR", "observed_at": at("2024-01-01 23:59:59.999")},
        {"price_amount": None, "source_offer_id": "2"},
        {"price_amount": None, "observed_at": at("2024-01-02 00:00:00")},
    )
    for scale in (None, 2):
        days = marts.agg_daily(marts.fct_offer_observations(rows), scale).orderBy("observation_date").collect()
        assert [tuple(d)[1:] for d in days] == [(3, 2, 15.0), (1, 1, None)]


def test_overview_runs_over_activity_days(spark):
    rows = observations(
        spark,
        {"source_offer_id": "1", "observed_at": at("2024-01-01 10:00:00")},
        {"source_offer_id": "2", "observed_at": at("2024-01-01 11:00:00")},
        {"source_offer_id": "1", "observed_at": at("2024-01-03 10:00:00")},
        {"source_offer_id": "3", "observed_at": at("2024-01-05 10:00:00")},
    )
    dim, daily = marts.dim_offers(rows), marts.agg_daily(marts.fct_offer_observations(rows))
    days = reports.rpt_marketplace_overview(dim, daily).orderBy("observation_date").collect()
    assert [(str(d.observation_date)[-2:], *d[1:4]) for d in days] == [
        ("01", 3, 2, 2),
        ("03", 3, 0, 2),
        ("05", 3, 1, 3),
    ]


def test_empty_input(spark):
    none = observations(spark)
    dim = marts.dim_offers(none)
    assert reports.rpt_brand_inventory(marts.agg_by_brand(dim)).collect() == []
    assert reports.rpt_fuel_type(marts.agg_by_fuel(dim)).collect() == []
    assert reports.rpt_price_distribution(dim).collect() == []
    daily = marts.agg_daily(marts.fct_offer_observations(none))
    assert reports.rpt_marketplace_overview(dim, daily).collect() == []


def test_exact_and_plain_daily_means_agree(spark, models):
    nan, inf = float("nan"), float("inf")
    days = [[10.0, nan, 20.0], [inf, 1.0], [-inf, inf], [1e17, 2.0], [1.5, 2.5], [None, 3.0], [None]]
    rows = observations(
        spark,
        *[
            {"observed_at": at(f"2024-01-{day + 1:02} 10:00:00"), "price_amount": price, "source_offer_id": str(i)}
            for day, prices in enumerate(days)
            for i, price in enumerate(prices)
        ],
    )
    fact = marts.fct_offer_observations(rows)
    plain, exact = (
        [r.average_price_amount for r in marts.agg_daily(fact, scale).orderBy("observation_date").collect()] for scale in (None, 2)
    )
    assert repr(plain) == repr(exact)
    assert repr(exact) == repr([nan, inf, nan, (1e17 + 2) / 2, 2.0, 3.0, None])


def test_exact_and_plain_daily_means_agree_on_the_given_tables(models):
    plain = {r.observation_date: r.average_price_amount for r in marts.agg_daily(models.fct()).collect()}
    exact = {r.observation_date: r.average_price_amount for r in marts.agg_daily(models.fct(), 2).collect()}
    assert plain.keys() == exact.keys() and len(plain) > 1000
    assert all(a == b or abs(a - b) < 1e-9 * abs(b) for a, b in zip(plain.values(), (exact[d] for d in plain)))
