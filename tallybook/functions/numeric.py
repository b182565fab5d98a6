"""Ratios and rounding that give the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type of every money total: per-row money is decimal(12,2), a sum of it is decimal(38,2).
MONEY = "decimal(38,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def half_up(c: Column, digits: int) -> Column:
    """Round a double half away from zero in binary arithmetic.

    ``F.round`` goes through the decimal text of the double (0.285 -> 0.29) where other engines scale the
    double itself (0.285 -> 0.28); scaling it here too keeps published percentages comparable.
    """
    scale = float(10**digits)
    return F.signum(c) * (F.floor(F.abs(c) * scale + 0.5) / F.lit(scale))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int) -> Column:
    """Share in percent.  The factor 100 is applied before the cast so that decimals stay exact."""
    return half_up(ratio(num * F.lit(100), den), digits)


def mean_of_sum(total: Column, n: Column, digits: int) -> Column:
    return half_up(ratio(total, n), digits)
