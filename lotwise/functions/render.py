"""Text rendering of numbers for messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_text(value: Column) -> Column:
    """Double as plain digits with at least one decimal (``12345678.0``), switching to
    ``1e+16`` style at 1e16 and above and below 1e-4. A cast to string alone would switch
    at 1e7 and 1e-3.
    """
    size = F.abs(value)
    plain = value.cast("string")
    # NULL branch values keep out-of-range doubles away from the decimal casts.
    large = F.when((size >= 1e7) & (size < 1e16), value).cast("decimal(38,12)").cast("string")
    small = F.when((size >= 1e-4) & (size < 1e-3), value).cast("decimal(38,24)").cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(plain, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(plain, r"E(-?[0-9]+)$", 1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), plain)
        .when((size >= 1e7) & (size < 1e16), _trim_zeros(large))
        .when((size >= 1e-4) & (size < 1e-3), _trim_zeros(small))
        .otherwise(scientific)
    )


def _trim_zeros(text: Column) -> Column:
    return F.regexp_replace(text, r"(\.[0-9]+?)0+$", "$1")


def strip(text: Column) -> Column:
    """Remove white space, line ends included, at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
