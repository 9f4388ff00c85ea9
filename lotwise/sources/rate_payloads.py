"""Stored exchange-rate payloads (JSON) to rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lotwise.functions.coerce import is_kind
from lotwise.functions.once import computed_once
from lotwise.schemas import RATE_COLUMNS, RATE_PAYLOAD

# Fixed values.
QUOTE_CURRENCY = "PLN"
PROVIDER = "NBP"


def parse_rates(payloads: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rates, and the rejected payloads with their reason.

    ``payloads`` has requested_currency, payload, fetched_at; the newest rate is the last
    of a payload. With ``strict``, reading the rates fails on the first reject.
    """
    kept = [c for c in payloads.columns if c != "payload"]
    # In an array, text after the JSON value does not parse, or shows as a second element.
    text = F.concat(F.lit("["), F.col("payload"), F.lit("]"))
    documents = F.from_json(text, ArrayType(RATE_PAYLOAD), {"allowSingleQuotes": "false"})
    parsed = payloads.withColumn("documents", documents)
    parsed = parsed.withColumn("document", F.when(F.size("documents") == 1, F.get("documents", F.lit(0))))
    newest = F.try_element_at("document.rates", F.lit(-1))
    mid = newest["mid"]
    rate = parsed.select(
        *kept,
        F.upper("requested_currency").alias("base_currency"),
        F.upper("document.code").alias("code"),
        # Only a JSON number is a rate; text that spells one is not.
        F.when(is_kind(mid, "BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get(mid, "$", "decimal(18,8)")).alias("rate_to_pln"),
        newest["no"].alias("source_table"),
        F.try_to_date(newest["effectiveDate"], "yyyy-MM-dd").alias("effective_date"),
        newest.isNotNull().alias("has_rate"),
    )
    reason = (
        F.when(F.col("code").isNull() | ~F.col("has_rate"), "bad_payload")
        .when(F.col("code") != F.col("base_currency"), "wrong_currency")
        .when(F.col("rate_to_pln").isNull() | F.col("source_table").isNull(), "bad_payload")
        .when(F.col("rate_to_pln") <= 0, "non_positive_rate")
        .when(F.col("effective_date").isNull(), "bad_date")
    )
    checked = computed_once(rate, *rate.columns, reason.alias("reject_reason"))
    usable = F.col("reject_reason").isNull()
    if strict:
        refuse = F.raise_error(F.concat(F.lit("rate payload rejected: "), F.col("reject_reason"))).cast("boolean")
        usable = F.when(usable, F.lit(True)).otherwise(refuse)
    good = checked.filter(usable).select(
        "effective_date",
        "base_currency",
        F.lit(QUOTE_CURRENCY).alias("quote_currency"),
        "rate_to_pln",
        F.lit(PROVIDER).alias("provider"),
        "source_table",
        "fetched_at",
    ).select(*RATE_COLUMNS)
    rejected = checked.filter(F.col("reject_reason").isNotNull()).select(*kept, "reject_reason")
    return good, rejected
