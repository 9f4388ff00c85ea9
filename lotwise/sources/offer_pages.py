"""Stored offer pages (HTML with embedded JSON) to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.coerce import as_text, is_kind, not_a, to_float, to_int
from lotwise.functions.once import computed_once
from lotwise.schemas import OBSERVATION_COLUMNS

# Where the pages keep their data.
SCRIPT_ID = "__NEXT_DATA__"
PAGE_DOCUMENTS = (
    "array<struct<props struct<pageProps struct<advert struct<"
    "id string, url string, title string, price map<string, variant>, "
    "parametersDict struct<make variant, model variant, year variant, mileage variant, "
    "fuel_type variant, gearbox variant>>>>>>"
)
PARAMETERS = [
    # column, parameter name, field of its first value
    ("brand", "make", "label"),
    ("model", "model", "label"),
    ("year", "year", "value"),
    ("mileage_km", "mileage", "value"),
    ("fuel_type", "fuel_type", "value"),
    ("transmission", "gearbox", "value"),
]

# All repeats are possessive: Java matches those in a loop, without a stack frame each.
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
BEFORE_ID = r"""(?:(?!\s(?i:id)\s*=)(?:[^>"']|"[^"]*+"|'[^']*+'))*+"""
IS_DATA = rf"""\s(?i:id)\s*=\s*(?:"{SCRIPT_ID}"|'{SCRIPT_ID}'|{SCRIPT_ID}(?=[\s>/]))"""
DATA_SCRIPT = rf"<(?i:script)\b{BEFORE_ID}{IS_DATA}{ATTRIBUTES}"
COMMENT = r"<!--[^-]*+(?:-(?!->)[^-]*+)*+(?:-->|\z)"
TEXT_ELEMENT = (
    rf"<(?i:(script|style|textarea|title))\b{ATTRIBUTES}>"
    r"[^<]*+(?:<(?!/(?i:\1)[\s/>])[^<]*+)*+(?:</(?i:\1)[\s/>]|\z)"
)
# A tag that the page ends in, perhaps within a quoted value, takes all that is left: no
# element follows it. Tried before what begins with a tag, so that nothing else scans to the
# end from every such tag.
CUT_OFF = rf"""<(?i:script|style|textarea|title)\b{ATTRIBUTES}(?:["'].*+)?\z"""
# Up to the first data script. Comments and elements whose content is text are taken whole
# on the way, so that a tag inside one is not mistaken for an element of the page.
PAGE_JSON = (
    rf"(?s)\A(?:[^<]++|{CUT_OFF}|(?!{DATA_SCRIPT}>)(?:{COMMENT}|{TEXT_ELEMENT}|<))*+{DATA_SCRIPT}"
    r"(>[^<]*+(?:<(?!/(?i:script)[\s/>])[^<]*+)*+)"
)


def page_json(html: Column) -> Column:
    """Text of the page's first script with the data id; NULL if there is none."""
    # The match holds the end of the tag, so that an empty script is not taken for none.
    # Said once: the condition and the value of a ``when`` would each match the whole page.
    found = F.nullif(F.regexp_extract(html, PAGE_JSON, 2), F.lit(""))
    return F.substr(found, F.lit(2))


def extract_page_json(pages: DataFrame, html_col: str = "html") -> DataFrame:
    return pages.withColumn("page_json", page_json(F.col(html_col)))


def parameter(entry: Column) -> Column:
    """Members of a parameter's first value; NULL where any step to it is missing."""
    return F.try_variant_get(entry, "$.values[0]", "map<string,variant>")


def _malformed(entry: Column) -> Column:
    """True where a parameter is not an object, its values are not a list, or the first of
    them is not an object."""
    values = F.try_variant_get(entry, "$.values", "variant")
    first = F.try_variant_get(entry, "$.values[0]", "variant")
    return not_a(entry, "OBJECT") | not_a(values, "ARRAY") | (first.isNotNull() & ~is_kind(first, "OBJECT"))


def parse_pages(
    pages: DataFrame, run_id: Column, observed_at_col: str = "observed_at", html_col: str = "html"
) -> DataFrame:
    """Other columns of ``pages``, the observation columns and ``reject_reason``, which is
    NULL for usable pages. No page stops the job."""
    taken = [c for c in pages.columns if c not in OBSERVATION_COLUMNS and c != html_col]
    found = pages.select(
        *taken,
        F.col(observed_at_col).alias("observed_at"),
        run_id.alias("scrape_run_id"),
        page_json(F.col(html_col)).alias("json"),
    )
    # In an array, text after the JSON value does not parse, or shows as a second element.
    text = F.concat(F.lit("["), F.col("json"), F.lit("]"))
    documents = F.from_json(text, PAGE_DOCUMENTS, {"allowSingleQuotes": "false"})
    parsed = found.withColumn("documents", documents)
    advert = F.get("documents", F.lit(0))["props"]["pageProps"]["advert"]
    names = [name for _, name, _ in PARAMETERS]
    entries = {name: advert["parametersDict"][name] for name in names}
    fields = parsed.select(
        *taken,
        "observed_at",
        "scrape_run_id",
        "json",
        (F.size("documents") == 1).alias("one_document"),
        advert.alias("advert"),
        *[parameter(entries[name]).alias(f"p_{name}") for name in names],
    )
    # A parameter that is there is well formed. Of the others few are on most pages.
    some_absent = F.greatest(*[F.col(f"p_{name}").isNull() for name in names])
    unread = F.array(*[F.when(F.col(f"p_{name}").isNull(), F.col(f"advert.parametersDict.{name}")) for name in names])
    typed = fields.withColumns(
        {
            "year": to_int(F.col("p_year")["value"]),
            "mileage_km": to_int(F.col("p_mileage")["value"]),
            "price_amount": to_float(F.col("advert.price")["value"]),
            "malformed": F.when(some_absent, F.exists(unread, _malformed)).otherwise(F.lit(False)),
        }
    )

    def absent(*members: str) -> Column:
        return F.greatest(*[F.col(f"advert.{m}").isNull() for m in members])

    price = F.col("advert.price")
    reason = (
        F.when(F.col("json").isNull(), "no_page_json")
        .when(~F.coalesce("one_document", F.lit(False)), "bad_json")
        .when(F.col("advert").isNull(), "no_advert")
        # The currency may be null but must be named.
        .when(absent("id", "url", "title", "price") | price["value"].isNull() | price["currency"].isNull(), "missing_key")
        .when(F.col("advert.parametersDict").isNull() | F.col("malformed"), "bad_parameters")
        .when(F.col("year").isNull(), "bad_year")
        .when(F.col("mileage_km").isNull(), "bad_mileage")
        .when(F.col("price_amount").isNull(), "bad_price")
    )
    texts = {
        column: as_text(F.col(f"p_{name}")[field]).alias(column)
        for column, name, field in PARAMETERS
        if column not in ("year", "mileage_km")
    }
    return computed_once(
        typed,
        *taken,
        F.col("advert.id").alias("source_offer_id"),
        "advert.url",
        "advert.title",
        texts["brand"],
        texts["model"],
        "year",
        "mileage_km",
        texts["fuel_type"],
        texts["transmission"],
        "price_amount",
        as_text(price["currency"]).alias("price_currency"),
        "observed_at",
        "scrape_run_id",
        reason.alias("reject_reason"),
    )


def pages_to_observations(
    pages: DataFrame, run_id: Column, observed_at_col: str = "observed_at", html_col: str = "html"
) -> tuple[DataFrame, DataFrame]:
    """Observations, and the rejected pages with their reason."""
    return split_parsed(parse_pages(pages, run_id, observed_at_col, html_col))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations and rejects among the rows of ``parse_pages``."""
    good = parsed.filter(F.col("reject_reason").isNull()).select(*OBSERVATION_COLUMNS)
    taken = [c for c in parsed.columns if c not in OBSERVATION_COLUMNS and c != "reject_reason"]
    rejected = parsed.filter(F.col("reject_reason").isNotNull()).select(*taken, "observed_at", "scrape_run_id", "reject_reason")
    return good, rejected
