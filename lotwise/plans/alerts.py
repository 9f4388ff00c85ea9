"""Message texts about the latest offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.render import float_text, strip
from lotwise.operators.digest import join_lines, top_per_group

# Sizes and texts of the messages.
TOP_OFFERS = 10
MESSAGE_LIMIT = 2000
TITLE_LIMIT = 55
URL_LIMIT = 80
LATEST_HEADER = "Top 10 latest offers"
NOTHING_OBSERVED = "No offers have been observed yet."
NOTHING_IN_RUN = "No offers found in this scrape run."
UNTITLED = "Untitled offer"
NO_PRICE = "price unavailable"
NO_MILEAGE = "mileage unavailable"
DONE_MARK = "\N{WHITE HEAVY CHECK MARK}"

RUN_COLUMNS = ["title", "brand", "model", "year", "mileage_km", "price_amount", "price_currency", "url"]
LATEST_COLUMNS = [*RUN_COLUMNS, "observed_at"]


def _newest() -> list[Column]:
    """Newest first, NULL times last, ties by offer."""
    return [F.desc("observed_at"), F.asc("source_offer_id"), F.asc("scrape_run_id"), F.asc("url")]


def latest_observations(observations: DataFrame) -> DataFrame:
    """Newest 10 observations overall, with their rank."""
    return top_per_group(observations, [], _newest(), TOP_OFFERS).select("rank", *LATEST_COLUMNS)


def latest_in_runs(observations: DataFrame) -> DataFrame:
    """Newest 10 observations of every run, with their rank; filter by run for one."""
    top = top_per_group(observations, ["scrape_run_id"], _newest(), TOP_OFFERS)
    return top.select("scrape_run_id", "rank", *RUN_COLUMNS)


def _number(column: str) -> Column:
    return F.col(column).cast("string")


def latest_digest(latest: DataFrame) -> DataFrame:
    """One message from ``latest_observations``, cut before the message limit."""
    vehicle = F.concat_ws(" ", "brand", "model", _number("year"))
    price = F.concat_ws(" ", float_text(F.col("price_amount")), "price_currency")
    mileage = F.coalesce(F.concat(F.lit(" | "), _number("mileage_km"), F.lit(" km")), F.lit(""))
    line = F.concat(
        _number("rank"), F.lit(". "), "title", F.lit(" — "), vehicle, mileage, F.lit(" | "), price, F.lit("\n"), "url"
    )
    text = join_lines(latest, [], line, header=LATEST_HEADER, budget=MESSAGE_LIMIT)
    return text.select(F.coalesce("text", F.lit(NOTHING_OBSERVED)).alias("message"))


def run_lines(latest: DataFrame) -> DataFrame:
    """Offer lines per run from ``latest_in_runs``, as one text per run."""

    def present(text: Column) -> Column:
        return F.nullif(text, F.lit(""))

    title = F.coalesce(present(F.col("title")), F.lit(UNTITLED))
    title = F.substring(F.replace(title, F.lit("\n"), F.lit(" ")), 1, TITLE_LIMIT)
    vehicle = F.concat_ws(" ", present(F.col("brand")), present(F.col("model")), _number("year"))
    price = F.concat_ws(" ", float_text(F.col("price_amount")), present(F.col("price_currency")))
    price = F.coalesce(present(price), F.lit(NO_PRICE))
    mileage = F.coalesce(F.concat(_number("mileage_km"), F.lit(" km")), F.lit(NO_MILEAGE))
    details = F.concat_ws(" | ", present(vehicle), price, mileage)
    url = F.substring(F.coalesce("url", F.lit("")), 1, URL_LIMIT)
    line = strip(F.concat(_number("rank"), F.lit(". "), title, F.lit(" — "), details, F.lit("\n"), url))
    return join_lines(latest, ["scrape_run_id"], line)


def run_digests(runs: DataFrame, latest: DataFrame, job: str = "Scraper", store: str = "the warehouse") -> DataFrame:
    """One message per run of ``runs`` (scrape_run_id, rows_loaded, duration_seconds), all
    runs in one job. ``job`` and ``store`` are the names the message uses."""
    lines = runs.join(run_lines(latest), "scrape_run_id", "left")
    message = F.concat(
        F.lit(f"{DONE_MARK} {job} completed\nScrape run: `"),
        F.col("scrape_run_id"),
        F.lit(f"`\nRows loaded into {store}: "),
        _number("rows_loaded"),
        F.lit("\nDuration: "),
        F.format_string("%.1f", F.col("duration_seconds").cast("double")),
        F.lit("s\n\nLatest offers:\n"),
        F.coalesce("text", F.lit(NOTHING_IN_RUN)),
    )
    return lines.select("scrape_run_id", message.alias("message"))
