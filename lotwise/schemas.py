"""Schemas of the stored tables and of the JSON payloads."""

from __future__ import annotations

from pyspark.sql import types as T

# Table columns, in order.
OBSERVATIONS = T.StructType(
    [
        T.StructField("source_offer_id", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("brand", T.StringType(), True),
        T.StructField("model", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("mileage_km", T.IntegerType(), True),
        T.StructField("fuel_type", T.StringType(), True),
        T.StructField("transmission", T.StringType(), True),
        T.StructField("price_amount", T.DoubleType(), True),
        T.StructField("price_currency", T.StringType(), True),
        T.StructField("observed_at", T.TimestampType(), False),
        T.StructField("scrape_run_id", T.StringType(), False),
    ]
)

RATES = T.StructType(
    [
        T.StructField("effective_date", T.DateType(), False),
        T.StructField("base_currency", T.StringType(), False),
        T.StructField("quote_currency", T.StringType(), False),
        T.StructField("rate_to_pln", T.DecimalType(18, 8), False),
        T.StructField("provider", T.StringType(), False),
        T.StructField("source_table", T.StringType(), False),
        T.StructField("fetched_at", T.TimestampType(), False),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("scrape_run_id", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
        T.StructField("rows_loaded", T.LongType(), False),
    ]
)

OBSERVATION_COLUMNS = OBSERVATIONS.fieldNames()
RATE_COLUMNS = RATES.fieldNames()

# Key columns of the versioned rate table and of the ledger (last version per key wins).
RATE_KEYS = ["effective_date", "base_currency", "quote_currency", "provider"]
LEDGER_KEYS = ["scrape_run_id"]

MONTH = "observed_month"

# Stored observations carry the month as a directory column.
STORED_OBSERVATIONS = T.StructType(
    [*OBSERVATIONS.fields, T.StructField(MONTH, T.StringType(), True)]
)

MERGED_RUNS = T.StructType(
    [T.StructField(MONTH, T.StringType(), False), T.StructField("scrape_run_id", T.StringType(), False)]
)

# What an ingest has added to the lake: a row for each run of a batch.
MANIFEST = T.StructType(
    [
        T.StructField("scrape_run_id", T.StringType(), False),
        T.StructField("batch", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
    ]
)

# A merge of months: those before ``month`` are read from merged files from then on.
MERGES = T.StructType([T.StructField("number", T.LongType()), T.StructField(MONTH, T.StringType())])

# Counts are 32-bit integers in the source's query language; a larger number reads as NULL.
LISTING = T.StructType(
    [
        T.StructField("totalCount", T.IntegerType()),
        T.StructField("pageInfo", T.StructType([T.StructField("pageSize", T.IntegerType())])),
        # Each edge is judged by itself, so one that is odd does not take the others with it.
        T.StructField("edges", T.VariantType()),
    ]
)

RATE_PAYLOAD = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField(
            "rates",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("no", T.StringType()),
                        T.StructField("effectiveDate", T.StringType()),
                        T.StructField("mid", T.VariantType()),
                    ]
                )
            ),
        ),
    ]
)
