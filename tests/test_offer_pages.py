import json

import pytest
from pyspark.sql import functions as F

from lotwise.sources.offer_pages import extract_page_json, pages_to_observations
from tests.samples import at

ADVERT = {
    "id": "77",
    "url": "https://market.example/offer/77",
    "title": "A \"red\" car — ż",
    "price": {"value": "12345.5", "currency": "EUR"},
    "parametersDict": {
        "make": {"values": [{"value": "bmw", "label": "BMW"}]},
        "model": {"values": [{"value": "3", "label": "Series 3"}, {"value": "x", "label": "other"}]},
        "year": {"values": [{"value": "2015", "label": "2015 r."}]},
        "mileage": {"values": [{"value": "120000", "label": "120 000 km"}]},
        "fuel_type": {"values": [{"value": "diesel", "label": "Diesel"}]},
        "gearbox": {"values": [{"value": "manual", "label": "Manualna"}]},
        "colour": "not an object, and not read",
    },
}


def advert(**changes):
    return {**ADVERT, **changes}


def parameters(**changes):
    return advert(parametersDict={**ADVERT["parametersDict"], **changes})


def without(key):
    return {k: v for k, v in ADVERT.items() if k != key}


def page(value):
    text = json.dumps({"props": {"pageProps": {"advert": value}}}, ensure_ascii=False)
    return f'<html><body><script id="__NEXT_DATA__" type="application/json">{text}</script></body></html>'


def first(value):
    return {"values": [{"value": value}]}


def parse(spark, *htmls):
    pages = spark.createDataFrame(
        [(i, html, at("2024-01-01 00:00:00")) for i, html in enumerate(htmls)], "page int, html string, observed_at timestamp"
    )
    good, rejected = pages_to_observations(pages, F.lit("run-9"))
    return good.collect(), {r.page: r.reject_reason for r in rejected.collect()}


def test_typed_observation(spark):
    (row,), rejected = parse(spark, page(ADVERT))
    assert rejected == {}
    assert row.asDict() == {
        "source_offer_id": "77",
        "url": "https://market.example/offer/77",
        "title": "A \"red\" car — ż",
        "brand": "BMW",
        "model": "Series 3",
        "year": 2015,
        "mileage_km": 120000,
        "fuel_type": "diesel",
        "transmission": "manual",
        "price_amount": 12345.5,
        "price_currency": "EUR",
        "observed_at": row.observed_at,
        "scrape_run_id": "run-9",
    }


KEPT = [
    # changed page, column, value
    (advert(price={"value": 100, "currency": None}), "price_currency", None),
    (advert(price={"value": " 1e3 ", "currency": "PLN"}), "price_amount", 1000.0),
    (advert(id=5), "source_offer_id", "5"),
    (parameters(make=None), "brand", None),
    (parameters(make={}), "brand", None),
    (parameters(make=""), "brand", None),
    (parameters(make=[]), "brand", None),
    (parameters(make={"values": []}), "brand", None),
    (parameters(make={"values": None}), "brand", None),
    (parameters(make={"values": [{"value": "no label"}]}), "brand", None),
    (parameters(fuel_type={"values": [{"label": "no value"}]}), "fuel_type", None),
    (parameters(year=first(2001.7)), "year", 2001),
    (parameters(year=first(" 2002\n")), "year", 2002),
    (parameters(mileage=first("1_000")), "mileage_km", 1000),
    (parameters(mileage=first(0)), "mileage_km", 0),
]


def test_unusual_pages_are_kept(spark):
    rows, rejected = parse(spark, *[page(value) for value, _, _ in KEPT])
    assert rejected == {}
    # Rows come back in page order: one partition per page range, nothing shuffled.
    assert [row[column] for row, (_, column, _) in zip(rows, KEPT)] == [value for _, _, value in KEPT]


REJECTED = [
    ("<html></html>", "no_page_json"),
    ("", "no_page_json"),
    (None, "no_page_json"),
    ('<script id="__NEXT_DATA__x">{}</script>', "no_page_json"),
    ('<script data-id="__NEXT_DATA__">{}</script>', "no_page_json"),
    ('<script id="__NEXT_DATA__">{"props":</script>', "bad_json"),
    ('<script id="__NEXT_DATA__">{\'props\': 1}</script>', "bad_json"),
    (page(ADVERT).replace("</script>", " {}</script>"), "bad_json"),
    (page(ADVERT).replace("</script>", ',{"a":1}</script>'), "bad_json"),
    ('<script id="__NEXT_DATA__"></script>', "bad_json"),
    (page(advert(deep=0)).replace('"deep": 0', '"deep": ' + "[" * 5000 + "]" * 5000), "bad_json"),
    ('<script id="__NEXT_DATA__">{"props":{}}</script>', "no_advert"),
    (page(None), "no_advert"),
    (page([1]), "no_advert"),
    (page(without("id")), "missing_key"),
    (page(without("price")), "missing_key"),
    (page(advert(price={"value": 1})), "missing_key"),
    (page(advert(price=5)), "missing_key"),
    (page(advert(title=None)), "missing_key"),
    (page(advert(parametersDict=None)), "bad_parameters"),
    (page(without("parametersDict")), "bad_parameters"),
    (page(parameters(make="text")), "bad_parameters"),
    (page(parameters(make={"values": "text"})), "bad_parameters"),
    (page(parameters(make={"values": [None]})), "bad_parameters"),
    (page(parameters(gearbox={"values": ["manual"]})), "bad_parameters"),
    (page(parameters(year=None)), "bad_year"),
    (page(parameters(year=first("2001.0"))), "bad_year"),
    (page(parameters(year=first("new"))), "bad_year"),
    (page(parameters(mileage=first(None))), "bad_mileage"),
    (page(parameters(mileage=first("99999999999"))), "bad_mileage"),
    (page(advert(price={"value": None, "currency": "PLN"})), "bad_price"),
    (page(advert(price={"value": "12 000", "currency": "PLN"})), "bad_price"),
]


def test_reject_reasons(spark):
    good, rejected = parse(spark, *[html for html, _ in REJECTED])
    assert good == []
    assert rejected == {i: reason for i, (_, reason) in enumerate(REJECTED)}


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<script id=__NEXT_DATA__>{}</script>", "{}"),
        ("<SCRIPT type='x'\n ID='__NEXT_DATA__'>{1}</SCRIPT >", "{1}"),
        ('<!-- <script id="__NEXT_DATA__">no</script> --><script id="__NEXT_DATA__">yes</script>', "yes"),
        ('<script>var a = \'<script id="__NEXT_DATA__">no\';</script><script id="__NEXT_DATA__">yes</script>', "yes"),
        ('<script id="__NEXT_DATA__">1</script><script id="__NEXT_DATA__">2</script>', "1"),
        ('<script data-a="x>y" id="__NEXT_DATA__">{"a":"<b></b>"}</script>', '{"a":"<b></b>"}'),
        ('<style>p > b {}</style><script id="__NEXT_DATA__">{"open": 1}', '{"open": 1}'),
        ("<" * 200_000 + "<script " + "a " * 100_000 + "id=__NEXT_DATA__>" + "<b" * 200_000 + "</script>", "<b" * 200_000),
        ("<!--" + "- " * 200_000 + "--><script>" + "</b>" * 200_000 + "</script><script id=__NEXT_DATA__>1</script>", "1"),
        ("<p>" + "x" * 200_000 + "</p><script id='__NEXT_DATA__'>" + "7" * 200_000 + "</script>", "7" * 200_000),
    ],
)
def test_page_json(spark, html, expected):
    df = spark.createDataFrame([(html,)], "html string")
    assert extract_page_json(df).first().page_json == expected


@pytest.mark.parametrize("tail", ["", "\"", "'"])
def test_unterminated_tags_take_linear_time(spark, tail):
    import time

    def seconds(size):
        page = ("<script " * (size // 8))[: size - 1] + tail
        rows = spark.createDataFrame([(page,)], "html string")
        start = time.perf_counter()
        assert extract_page_json(rows).first().page_json is None
        return time.perf_counter() - start

    seconds(1024)
    small, large = min(seconds(128 * 1024) for _ in range(3)), min(seconds(256 * 1024) for _ in range(3))
    assert large < 2 and large < 2.5 * small + 0.3


def test_data_before_a_cut_off_tag_is_found(spark):
    data = '<script id="__NEXT_DATA__">{"a":1}</script>'
    pages = [data + "<script ", "<title>x</title>" + data + '<style a="', "<textarea " + data, "<script a='" + data]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    found = [r.page_json for r in extract_page_json(rows).orderBy("i").collect()]
    assert found == ['{"a":1}', '{"a":1}', None, None]


def test_a_page_is_matched_once(spark):
    pages = spark.createDataFrame([("<script id='__NEXT_DATA__'></script>",), ("<p>",), (None,)], "html string")
    found = extract_page_json(pages)
    assert [row.page_json for row in found.collect()] == ["", None, None]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
