"""Aggregates whose result does not depend on the row order.

Adding doubles in another order changes the last digits, so two runs over the same data could disagree. A sum here adds up
two whole numbers for each value, what stands before the point and what stands behind it in units of 10^-8, and turns the
totals into one double in the end. Whole numbers give the same total in any order, and cost about as much as a double sum.

Values are so taken to 8 decimals; a double above 10^8 has no more of them anyway. NULL values are skipped and a sum
of none is NULL. NaN, infinities and amounts of 2^53 or more are added as doubles beside the others, so that the first two
give what a plain sum would give. A whole total of 9.2 * 10^18 or more is an error and not a wrong number.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 100_000_000
#: Standard deviations are built from squares, which whole numbers cannot hold; they are rounded to this.
DECIMALS = 4


def stable_sum(c: Column) -> Column:
    x = c.cast("double")
    plain = F.abs(x) < float(2**53)
    before = F.floor(x)
    behind = F.floor((x - before) * float(UNITS) + 0.5)
    units = F.sum(F.when(plain, behind)).cast("decimal(20,0)") * F.lit(Decimal(1) / UNITS).cast("decimal(8,8)")
    exact = (F.sum(F.when(plain, before)).cast("decimal(28,8)") + units).cast("double")
    rest = F.sum(F.when(~plain, x))
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def stable_avg(c: Column) -> Column:
    return F.try_divide(stable_sum(c), F.count(c))


def stable_std(c: Column) -> Column:
    """Sample standard deviation; NULL for a single row.

    Rounded, so that the order of rows shows only where a result lies next to the middle of two rounded values.
    """
    return F.round(F.stddev_samp(c), DECIMALS)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
