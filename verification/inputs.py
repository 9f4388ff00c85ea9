"""Marketplace inputs derived from the given tables.

``OBS``, ``RATES`` and ``PAGE_PARTS`` are written so that Spark and DuckDB read them the
same way; the oracle uses them as CTEs. Payloads (pages, listings, rate payloads) are
rendered from them, so that an extractor's expected result is what it was rendered from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBS = """
SELECT CAST(l_partkey AS STRING) AS source_offer_id,
  concat('https://market.example/offer/', CAST(l_partkey AS STRING)) AS url,
  p_name AS title,
  CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN 'unknown' ELSE p_brand END AS brand,
  CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE p_type END AS model,
  CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE 1975 + p_size END AS year,
  CASE WHEN l_partkey % 29 = 0 THEN NULL
       ELSE CAST((l_orderkey * 37 + l_linenumber * 1000) % 300000 AS INT) END AS mileage_km,
  CASE l_partkey % 6 WHEN 0 THEN 'petrol' WHEN 1 THEN 'diesel' WHEN 2 THEN 'hybrid'
                     WHEN 3 THEN 'electric' WHEN 4 THEN 'petrol-lpg' END AS fuel_type,
  CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 'automatic' ELSE 'manual' END AS transmission,
  CASE WHEN (l_orderkey + l_linenumber) % 31 = 0 THEN NULL ELSE l_extendedprice END AS price_amount,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL
       ELSE CASE (l_orderkey + l_partkey) % 7 WHEN 3 THEN 'EUR' WHEN 4 THEN 'EUR'
            WHEN 5 THEN 'USD' WHEN 6 THEN 'GBP' ELSE 'PLN' END END AS price_currency,
  l_shipdate + (l_orderkey * 8 + l_linenumber) * INTERVAL '0.001' SECOND AS observed_at,
  concat('run-', substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7)) AS scrape_run_id
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

RATES = """
SELECT CAST(o_orderdate AS DATE) AS effective_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'eur' WHEN 2 THEN 'USD' ELSE 'usd' END AS base_currency,
  CASE WHEN o_orderkey % 3 = 0 THEN 'pln' ELSE 'PLN' END AS quote_currency,
  CAST((3500 + o_orderkey % 1000) * 0.001 AS DECIMAL(18,8)) AS rate_to_pln,
  'NBP' AS provider,
  concat(CAST(o_orderkey % 255 AS STRING), '/A/NBP') AS source_table,
  o_orderdate + o_orderkey * INTERVAL '0.001' SECOND AS fetched_at
FROM {orders}
"""

# One page per observation. The shape of the page turns with the offer id: 0 to 5 are
# broken in one way each, 6 to 10 are unusual.
PAGE_PARTS = """
SELECT *, concat(
    '{{"props":{{"pageProps":{{"advert":{{"id":"', source_offer_id, '","url":"', url, '","title":"', title,
    '","price":{{"value":',
    CASE WHEN price_amount IS NULL OR shape = 5 THEN 'null'
         ELSE concat('"', CAST(CAST(price_amount AS DECIMAL(18,2)) AS STRING), '"') END,
    CASE WHEN shape = 2 THEN '' WHEN price_currency IS NULL THEN ',"currency":null'
         ELSE concat(',"currency":"', price_currency, '"') END,
    '}},"parametersDict":',
    CASE WHEN shape = 4 THEN 'null' ELSE concat('{{',
      CASE WHEN brand IS NULL THEN ''
           ELSE concat('"make":{{"values":[{{"value":"b","label":"', brand, '"}}]}},') END,
      CASE WHEN model IS NULL THEN '"model":{{"values":[]}},'
           ELSE concat('"model":{{"values":[{{"value":"m","label":"', model, '"}},{{"label":"other"}}]}},') END,
      '"year":{{"values":[',
      CASE WHEN shape = 3 THEN ''
           WHEN year IS NULL THEN '{{"value":null,"label":null}}'
           WHEN shape = 8 THEN concat('{{"value":', CAST(year AS STRING), '.7}}')
           WHEN shape = 10 THEN concat('{{"value":"', CAST(year AS STRING), '.0"}}')
           ELSE concat('{{"value":"', CAST(year AS STRING), '","label":"y"}}') END,
      ']}},',
      CASE WHEN mileage_km IS NULL THEN ''
           WHEN shape = 9 THEN concat('"mileage":{{"values":[{{"value":"  ', CAST(mileage_km AS STRING), ' "}}]}},')
           ELSE concat('"mileage":{{"values":[{{"value":"', CAST(mileage_km AS STRING), '"}}]}},') END,
      CASE WHEN fuel_type IS NULL THEN '"fuel_type":null,'
           ELSE concat('"fuel_type":{{"values":[{{"value":"', fuel_type, '"}}]}},') END,
      CASE WHEN transmission IS NULL THEN '"gearbox":{{"values":null}}'
           ELSE concat('"gearbox":{{"values":[{{"value":"', transmission, '"}}]}}') END,
      '}}') END,
    CASE WHEN shape = 1 THEN '}}}}}}' ELSE '}}}}}}}}' END) AS page_json
FROM (SELECT *, CAST(source_offer_id AS BIGINT) % 37 AS shape FROM obs) AS shaped
"""

# Edges that follow the good ones of some listings: four are rejects, one only has no URL.
ODD_EDGES = ',"oops",[1],{"node":7},{"node":{"url":{"a":1}}},{"node":{}}'

LEDGER_BEFORE = "run-1996-01"
MERGED_BEFORE = "199601"


def _table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A given table. One that is read in fewer splits than there are threads, so a small one,
    would have all that follows done by as few tasks; its rows are then spread by ``keys``."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    threads = spark.sparkContext.defaultParallelism
    if keys and table.rdd.getNumPartitions() < threads:
        return table.repartition(threads, *keys)
    return table


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return spark.sql(OBS, lineitem=lineitem, part=_table(spark, sf_dir, "part"))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RATES, orders=_table(spark, sf_dir, "orders"))


def ledger(observed: DataFrame) -> DataFrame:
    """The runs before a fixed month count as loaded."""
    loaded = observed.filter(F.col("scrape_run_id") < LEDGER_BEFORE)
    return loaded.groupBy("scrape_run_id").agg(F.count("*").alias("rows_loaded"))


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTML page per observation, with what it was rendered from."""
    parts = spark.sql(PAGE_PARTS.replace("FROM obs", "FROM {obs}"), obs=observations(spark, sf_dir))
    decoy = "<!-- <script id=\"__NEXT_DATA__\">{\"props\":1}</script> -->"
    attribute = (
        F.when(F.col("shape") == 0, F.lit('id="OTHER_DATA"'))
        .when(F.col("shape") == 7, F.lit("type='application/json' id='__NEXT_DATA__'"))
        .otherwise(F.lit('id="__NEXT_DATA__" type="application/json"'))
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"),
        F.col("title"),
        F.lit("</title><script>var tag = '<b id=\"__NEXT_DATA__\">';</script></head><body>"),
        F.when(F.col("shape") == 6, F.lit(decoy)).otherwise(F.lit("")),
        F.lit("<p data-id=\"__NEXT_DATA__\">offer</p><script "),
        attribute,
        F.lit(">"),
        F.col("page_json"),
        F.lit("</script><script id=\"__NEXT_DATA__\">{}</script></body></html>"),
    )
    # Shape 0 must have no data script at all.
    html = F.when(F.col("shape") == 0, F.replace(html, F.lit('<script id="__NEXT_DATA__">{}</script>'), F.lit("")))\
        .otherwise(html)
    return parts.withColumn("html", html)


def offer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered pages and the given web pages (which hold no offer data)."""
    rendered = rendered_pages(spark, sf_dir).select(
        F.col("source_offer_id").alias("page_id"), "observed_at", "scrape_run_id", "html"
    )
    given = _table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("page_id"),
        F.lit(None).cast("timestamp_ntz").alias("observed_at"),
        F.lit("run-pages").alias("scrape_run_id"),
        "html",
    )
    return rendered.unionByName(given)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing payloads: per run (target) and block of nine offer ids (page) one JSON
    document with the offers seen. Every fifth block is in two formats of nesting; an offer
    divisible by 25 has an empty URL. Every seventh block ends with odd edges, every 29th has
    an object in place of its edges."""
    seen = observations(spark, sf_dir).select("scrape_run_id", F.col("source_offer_id").cast("bigint").alias("offer"), "url")
    edge = F.struct(
        F.struct(
            F.when(F.col("offer") % 25 == 0, F.lit("")).otherwise(F.col("url")).alias("url"),
            F.lit("Advert").alias("__typename"),
        ).alias("node")
    )
    pages = (
        seen.distinct()
        .groupBy(F.col("scrape_run_id").alias("target"), F.expr("offer div 9 + 1").alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("offer"), F.to_json(edge).alias("edge")))).alias("edges"))
    )
    block = F.col("page")
    edges = F.array_join(F.transform("edges", lambda e: e["edge"]), ",")
    edges = F.concat(F.lit("["), edges, F.when(block % 7 == 0, F.lit(ODD_EDGES)).otherwise(F.lit("")), F.lit("]"))
    edges = F.when(block % 29 == 0, F.lit('{"node":{"url":"lost"}}')).otherwise(edges)
    size = F.when(block % 11 == 0, F.lit("0")).otherwise(F.lit("9"))
    total = F.when(block % 13 == 0, F.lit("")).otherwise(
        F.concat(F.lit('"totalCount":'), (block * 7 % 100).cast("string"), F.lit(","))
    )
    name = F.when(block % 17 == 0, F.lit("OtherOutput")).otherwise(F.lit("AdvertSearchOutput"))
    found = F.concat(
        F.lit('{"__typename":"'), name, F.lit('",'), total,
        F.lit('"pageInfo":{"pageSize":'), size, F.lit('},"edges":'), edges, F.lit("}"),
    )
    later = F.lit('{"__typename":"AdvertSearchOutput","totalCount":1,"pageInfo":{"pageSize":1},"edges":[]}')
    payload = (
        F.when(block % 19 == 0, F.lit('{"data":'))
        .when(block % 17 == 0, F.concat(F.lit('{"data":['), found, F.lit("]}")))
        .when(block % 5 == 0, F.concat(F.lit('{"z":[{"deep":['), found, F.lit(']}],"a":'), later, F.lit("}")))
        .otherwise(F.concat(F.lit('{"data":{"advertSearch":'), found, F.lit("}}")))
    )
    return pages.select("target", "page", payload.alias("payload"))


def rate_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload per fetch with the rate before it and the rate of that fetch; some ask for
    one currency and hold another, some hold a zero rate, a rate as text, more text after the
    document or a second document."""
    fetched = spark.sql(RATES, orders=_table(spark, sf_dir, "orders", "o_orderkey"))
    key = F.split("source_table", "/")[0].cast("int")
    entry = '{"no":"%s","effectiveDate":"%s","mid":%s}'
    older = F.format_string(entry, F.lit("0/A/NBP"), F.lit("1990-01-01"), F.lit("9.5"))
    shape = key % 15
    given = F.col("rate_to_pln").cast("string")
    mid = (
        F.when(key % 10 == 3, F.lit("0"))
        .when(key % 10 == 4, F.lit("-1.5"))
        .when(shape == 11, F.concat(F.lit('"'), given, F.lit('"')))
        .otherwise(given)
    )
    newest = F.format_string(entry, F.col("source_table"), F.col("effective_date").cast("string"), mid)
    body = F.when(key % 10 == 5, F.lit("")).otherwise(F.concat(older, F.lit(","), newest))
    payload = F.concat(F.lit('{"table":"A","code":"'), F.col("base_currency"), F.lit('","rates":['), body, F.lit("]}"))
    payload = F.when(shape == 12, F.concat(payload, F.lit(" and more"))).when(
        shape == 13, F.concat(payload, F.lit(" "), payload)
    ).otherwise(payload)
    asked = F.when(key % 10 == 6, F.lit("CHF")).otherwise(F.lower("base_currency"))
    return fetched.select(
        asked.alias("requested_currency"),
        F.when(key % 10 == 7, F.lit("<html>busy</html>")).otherwise(payload).alias("payload"),
        "fetched_at",
    )
