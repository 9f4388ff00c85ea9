"""Declared data-quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED = "accepted_values"
RELATIONSHIPS = "relationships"


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""


# The checks of each model.
_NOT_NULL = {
    "offers_observations": ["source_offer_id", "observed_at"],
    "currency_rates": ["effective_date", "base_currency", "quote_currency", "rate_to_pln"],
    "stg__currency_rates": [
        "effective_date",
        "price_currency",
        "quote_currency",
        "rate_to_pln",
        "provider",
        "source_table",
        "fetched_at",
    ],
    "dim__offers": ["offer_key", "first_observed_at", "last_observed_at", "observation_count"],
    "fct__offer_observations": ["offer_key", "observed_at"],
    "agg__offers_by_brand": ["offer_count"],
    "agg__offers_by_fuel_type": ["offer_count"],
    "agg__daily_offer_observations": ["observation_date", "observation_count", "distinct_offer_count"],
    "rpt__marketplace_overview": [
        "observation_date",
        "current_offer_count",
        "new_offer_count",
        "cumulative_offer_count",
        "observation_count",
        "distinct_offer_count",
    ],
    "rpt__mileage_vs_price": ["offer_key", "mileage_km", "price_amount", "price_currency"],
    "rpt__price_distribution_by_vehicle": [
        "brand",
        "vehicle_model",
        "model_year",
        "price_currency",
        "offer_count",
        "minimum_price_amount",
        "median_price_amount",
        "maximum_price_amount",
    ],
}
_UNIQUE = {
    "dim__offers": ["offer_key"],
    "agg__daily_offer_observations": ["observation_date"],
    "rpt__marketplace_overview": ["observation_date"],
    "rpt__mileage_vs_price": ["offer_key"],
}
CHECKS = [
    *[Check(model, column, NOT_NULL) for model, columns in _NOT_NULL.items() for column in columns],
    *[Check(model, column, UNIQUE) for model, columns in _UNIQUE.items() for column in columns],
    Check("stg__currency_rates", "price_currency", ACCEPTED, values=("EUR", "USD")),
    Check("stg__currency_rates", "quote_currency", ACCEPTED, values=("PLN",)),
    Check("fct__offer_observations", "offer_key", RELATIONSHIPS, parent="dim__offers", parent_column="offer_key"),
]


class CheckFailed(ValueError):
    """Some checks of a model found failing rows."""


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULLs per column (column_name, failures), all columns in one pass."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("occurrences"))
    return counted.filter(F.col("occurrences") > 1)


def unaccepted(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the set with their rows; NULL passes."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("occurrences"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values that the parent does not have, with their rows. Child rows are counted
    per value before the join, so a frequent value is one row in it."""
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("occurrences"))
    known = parent.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check] = CHECKS) -> DataFrame:
    """Failures per check (model, column_name, check_kind, failures): failing rows for
    not_null and relationships, failing values for unique and accepted_values."""
    checks = list(checks)
    parts = []
    by_model: dict[str, list[str]] = {}
    for check in checks:
        if check.kind == NOT_NULL:
            by_model.setdefault(check.model, []).append(check.column)
    for model, columns in by_model.items():
        parts.append(_labelled(null_counts(tables[model], columns), model, NOT_NULL))
    for check in checks:
        if check.kind == NOT_NULL:
            continue
        table = tables[check.model]
        if check.kind == UNIQUE:
            failures = duplicates(table, check.column).agg(F.count("*").alias("failures"))
        elif check.kind == ACCEPTED:
            failures = unaccepted(table, check.column, check.values).agg(F.count("*").alias("failures"))
        else:
            missing = orphans(table, check.column, tables[check.parent], check.parent_column)
            failures = missing.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).cast("bigint").alias("failures"))
        named = failures.withColumn("column_name", F.lit(check.column))
        parts.append(_labelled(named, check.model, check.kind))
    return reduce(DataFrame.unionByName, parts)


def _labelled(failures: DataFrame, model: str, kind: str) -> DataFrame:
    return failures.select(
        F.lit(model).alias("model"), "column_name", F.lit(kind).alias("check_kind"), "failures"
    )


def require_passing(tables: Mapping[str, DataFrame], model: str) -> None:
    """Run one model's checks and raise if any fails, before anything is built on it."""
    checks = [check for check in CHECKS if check.model == model]
    if not checks:
        return
    # At most one row per declared check reaches the driver.
    failed = run_checks(tables, checks).filter("failures > 0").collect()
    if failed:
        found = ", ".join(f"{row.column_name} {row.check_kind}: {row.failures}" for row in failed)
        raise CheckFailed(f"{model}: {found}")
