"""Lenient conversions: a bad value becomes NULL, never an exception.

Spark 4 runs in ANSI mode, where a plain cast raises; these keep ANSI on and
still accept dirty exports.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(c: Column) -> Column:
    return c.try_cast("double")


def lenient_integer(c: Column, to: str = "bigint") -> Column:
    """Whole number from text; `12.0` reads as 12 and stays exact past 2^53, digits after the point are cut off.

    Always through a decimal: a failing text-to-integer cast builds an error
    per row and takes some thirty times longer.
    """
    return c.try_cast("decimal(38,18)").try_cast(to)


def lenient_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def trimmed(c: Column) -> Column:
    return F.trim(c)


def upper_trimmed(c: Column) -> Column:
    return F.upper(F.trim(c))


def guarded_ratio(numerator: Column, denominator: Column, default: float = 1.0) -> Column:
    """`numerator / denominator` where the denominator is positive, else `default`."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default))


def finite_or_zero(c: Column) -> Column:
    """NULL, NaN and the infinities read as 0: only finite values cancel to 0."""
    d = c.cast("double")
    return F.when(d - d == 0, d).otherwise(F.lit(0.0))
