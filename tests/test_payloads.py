import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from lotwise.plans.load import load_rates
from lotwise.sources.listings import distinct_urls, listing_edge_rejects, listing_pages, listing_urls, parse_listings
from lotwise.sources.rate_payloads import parse_rates
from lotwise.sources.tables import read_rates
from tests.samples import at


def search(total=20, size=9, urls=("u1", "u2"), **extra):
    edges = [{"node": {"url": u}} for u in urls]
    return {"__typename": "AdvertSearchOutput", "totalCount": total, "pageInfo": {"pageSize": size}, "edges": edges, **extra}


def listings(spark, *documents):
    texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
    return parse_listings(spark.createDataFrame(list(enumerate(texts)), "listing int, payload string"))


def test_first_node_in_document_order(spark):
    inner = search(urls=["inner"])
    documents = [
        {"z": [1, {"deep": search(urls=["first"])}], "a": search(urls=["second"])},
        [search(urls=["first"], nested=inner), inner],
        {"__typename": "Other", "a": None, "b": search(urls=["first"])},
    ]
    urls = listing_urls(listings(spark, *documents), ["listing"]).collect()
    assert [(u.listing, u.edge_pos, u.url) for u in urls] == [(0, 0, "first"), (1, 0, "first"), (2, 0, "first")]


def test_payload_without_the_node_is_rejected(spark):
    rows = listings(spark, {"a": 1}, "not json", None, "[" * 5000, search()).collect()
    assert [r.reject_reason for r in rows] == ["no_search_node"] * 4 + [None]


def test_odd_text_does_not_stop_the_job(spark):
    odd = json.dumps(search(urls=["a"], title="\ud800 lone, \U0001f697 car"))
    assert [u.url for u in listing_urls(listings(spark, odd), ["listing"]).collect()] == ["a"]


def test_empty_urls_are_left_out_and_positions_kept(spark):
    urls = listing_urls(listings(spark, search(urls=["a", "", None, "b"])), ["listing"]).collect()
    assert [(u.edge_pos, u.url) for u in urls] == [(0, "a"), (3, "b")]
    no_edges = {k: v for k, v in search().items() if k != "edges"}
    assert listing_urls(listings(spark, no_edges), ["listing"]).collect() == []


def test_odd_edges_are_rejected_one_by_one(spark):
    good, other = {"node": {"url": "a"}}, {"node": {"url": "b"}}
    odd = [
        [good, "oops", other], [good, [1], other], [good, None, other], [good, {"node": 7}, other], [good, {"node": None}, other],
        [good, {"node": {"url": {"a": 1}}}, other], [good, {"node": {"url": 5}}, other],
        [good, {}, other], [good, {"node": {}}, other], [good, {"node": {"url": None}}, other], [good, {"node": {"url": ""}}, other],
    ]
    documents = [{**search(), "edges": edges} for edges in [*odd, {"node": {"url": "lost"}}, None, "x", []]]
    parsed = listings(spark, *documents)
    urls = {}
    for row in listing_urls(parsed, ["listing"]).collect():
        urls.setdefault(row.listing, []).append((row.edge_pos, row.url))
    assert urls == {i: [(0, "a"), (2, "b")] for i in range(len(odd))}
    rejects = {(r.listing, r.edge_pos, r.reject_reason) for r in listing_edge_rejects(parsed, ["listing"]).collect()}
    n = len(odd)
    assert rejects == {(i, 1, "bad_edge") for i in range(7)} | {(i, None, "bad_edges") for i in (n, n + 1, n + 2)}


def test_planned_pages(spark):
    documents = [search(total=20), search(total=18), search(total=0), search(size=0), {"__typename": "AdvertSearchOutput"}, search(total=2**40)]
    planned, rejected = listing_pages(listings(spark, *documents), ["listing"])
    pages = {}
    for row in planned.collect():
        pages.setdefault((row.listing, row.page_count), []).append(row.page)
    assert pages == {(0, 3): [1, 2, 3], (1, 2): [1, 2], (2, 0): [1]}
    assert {r.listing: r.reject_reason for r in rejected.collect()} == {
        3: "zero_page_size",
        4: "missing_key",
        5: "missing_key",
    }


def test_many_pages_come_in_blocks(spark):
    planned, _ = listing_pages(listings(spark, search(total=9 * 10_000)), ["listing"])
    assert [r.page for r in planned.orderBy("page").collect()] == list(range(1, 10_001))


def test_url_is_kept_where_it_was_first_seen(spark):
    rows = [("b", 2, 1, 0), ("a", 1, 2, 5), ("b", 1, 3, 1), ("c", 1, 2, 4), ("a", 1, 2, 6)]
    urls = spark.createDataFrame(rows, "url string, target_pos int, page int, edge_pos int")
    kept = distinct_urls(urls, ["target_pos", "page", "edge_pos"]).collect()
    assert [tuple(r) for r in kept] == [("c", 1, 2, 4), ("a", 1, 2, 5), ("b", 1, 3, 1)]


def payloads(spark, *rows):
    return spark.createDataFrame(
        [(asked, text, at("2024-01-03 00:00:00")) for asked, text in rows],
        "requested_currency string, payload string, fetched_at timestamp",
    )


def rate(code="eur", mid="4.3215", date="2024-01-02"):
    older = '{"no":"1/A/NBP","effectiveDate":"2024-01-01","mid":9.99}'
    newest = f'{{"no":"2/A/NBP","effectiveDate":"{date}","mid":{mid}}}'
    return f'{{"table":"A","code":"{code}","rates":[{older},{newest}]}}'


def test_last_rate_of_a_payload(spark):
    (row,) = parse_rates(payloads(spark, ("Eur", rate())))[0].collect()
    assert (str(row.effective_date), row.base_currency, row.quote_currency, row.rate_to_pln, row.provider, row.source_table) == (
        "2024-01-02", "EUR", "PLN", Decimal("4.32150000"), "NBP", "2/A/NBP",
    )


BAD_RATES = [
    (("USD", rate()), "wrong_currency"),
    (("EUR", rate(mid="0")), "non_positive_rate"),
    (("EUR", rate(mid="-1")), "non_positive_rate"),
    (("EUR", rate(mid="null")), "bad_payload"),
    (("EUR", rate(date="2024-13-01")), "bad_date"),
    (("EUR", '{"code":"EUR","rates":[]}'), "bad_payload"),
    (("EUR", "<html>"), "bad_payload"),
    (("EUR", rate() + " and more"), "bad_payload"),
    (("EUR", rate() + "," + rate()), "bad_payload"),
    (("EUR", rate() + rate()), "bad_payload"),
    (("EUR", rate(mid='"4.5"')), "bad_payload"),
    (("EUR", rate(mid="[4.5]")), "bad_payload"),
    (("EUR", None), "bad_payload"),
]


def test_bad_rates(spark):
    good, rejected = parse_rates(payloads(spark, *[row for row, _ in BAD_RATES]))
    assert good.collect() == []
    assert [r.reject_reason for r in rejected.collect()] == [reason for _, reason in BAD_RATES]


def test_rate_spellings(spark):
    given = ["4", "4.32", "432e-2", "1234567890.12345678"]
    good, _ = parse_rates(payloads(spark, *[("EUR", rate(mid=m)) for m in given]))
    assert [r.rate_to_pln for r in good.collect()] == [Decimal(m).quantize(Decimal("1e-8")) for m in given]


@pytest.mark.parametrize("payload", [rate() + " x", rate() + rate(), rate(mid='"4.5"')])
def test_strict_stops_on_text_that_is_not_one_document(spark, payload):
    with pytest.raises(PySparkException, match="bad_payload"):
        parse_rates(payloads(spark, ("EUR", rate()), ("EUR", payload)), strict=True)[0].collect()


def test_strict_stops_on_a_bad_rate(spark):
    good, _ = parse_rates(payloads(spark, ("EUR", rate()), ("USD", rate())), strict=True)
    with pytest.raises(PySparkException, match="wrong_currency"):
        good.collect()
    assert parse_rates(payloads(spark, ("EUR", rate())), strict=True)[0].count() == 1


def test_rates_are_loaded_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "rates")
    load_rates(payloads(spark, ("EUR", rate()), ("usd", rate(code="USD"))), path)
    load_rates(payloads(spark, ("EUR", rate(date="2024-01-03"))), path)
    with pytest.raises(PySparkException):
        load_rates(payloads(spark, ("EUR", rate(date="2024-01-04")), ("USD", rate())), path)
    dates = [(r.base_currency, r.effective_date.day) for r in read_rates(spark, path).collect()]
    assert sorted(dates) == [("EUR", 2), ("EUR", 3), ("USD", 2)]


def test_executors_do_not_need_the_package(tmp_path):
    """A driver that found the package by path only, its Python workers without it."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "driver.py"
    script.write_text(
        "import sys\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"sys.path.insert(0, {root!r})\n"
        "from lotwise.sources.listings import parse_listings\n"
        "rows = spark.createDataFrame([('{\"a\": {\"__typename\": \"AdvertSearchOutput\", \"totalCount\": 7}}',)], 'payload string')\n"
        "print('total', parse_listings(rows).first().search.totalCount)\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "total 7" in run.stdout, run.stderr
