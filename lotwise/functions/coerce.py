"""Number coercions for values that arrive as loosely typed JSON.

Both take a VARIANT column and give NULL where the value does not convert, so that the
caller can turn it into a reject reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number spellings (blanks around, underscores between digits).
INT_TEXT = r"^\s*([+-]?[0-9]+(?:_[0-9]+)*)\s*$"
FLOAT_TEXT = (
    r"^\s*([+-]?(?:"
    r"[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?"
    r"|\.[0-9]+(?:_[0-9]+)*(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?"
    r"|(?i:inf|infinity|nan)))\s*$"
)


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def is_kind(value: Column, *kinds: str) -> Column:
    """True where the JSON value has one of the given kinds (STRING, OBJECT, ...)."""
    schema = F.schema_of_variant(value)
    matches = schema.startswith(kinds[0])
    for kind in kinds[1:]:
        matches = matches | schema.startswith(kind)
    return F.coalesce(matches, F.lit(False))


def not_a(value: Column, kind: str) -> Column:
    """There, not empty (null, "", 0, false, [] and {} are), and of another kind."""
    empty = F.coalesce(as_text(value).isin("", "0", "false", "[]", "{}"), F.lit(False))
    return value.isNotNull() & ~is_kind(value, kind, "VOID") & ~empty


def to_int(value: Column) -> Column:
    """Whole number: text must spell an integer, a JSON number is truncated."""
    digits = F.replace(F.regexp_extract(as_text(value), INT_TEXT, 1), F.lit("_"), F.lit(""))
    number = F.try_variant_get(value, "$", "double").try_cast("int")
    return F.when(is_kind(value, "STRING"), digits.try_cast("int")).otherwise(number)


def to_float(value: Column) -> Column:
    digits = F.replace(F.regexp_extract(as_text(value), FLOAT_TEXT, 1), F.lit("_"), F.lit(""))
    number = F.try_variant_get(value, "$", "double")
    return F.when(is_kind(value, "STRING"), digits.try_cast("double")).otherwise(number)
