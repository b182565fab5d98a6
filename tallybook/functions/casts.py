"""Text to contract type.  A value that does not fit becomes NULL; no row is lost.

Spark and the reference engine disagree on three casts, so the contract casts are written once here:
integers are rounded from decimal notation ('12.5' -> 13, '1e2' -> 100), a bare year is not a timestamp,
and decimals follow the declared scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PREFIX = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def to_integer(c: Column, strict: bool = False) -> Column:
    """Integer cast; ``strict=True`` refuses fractions and exponents as Spark's own cast does."""
    if strict:
        return c.try_cast("int")
    return F.round(c.try_cast("decimal(38,10)"), 0).try_cast("int")


def to_timestamp(c: Column) -> Column:
    # a year has four digits or more, so a text that casts and has its hyphens here begins with a full date; others are matched
    usual = (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    return F.when(usual | c.rlike(DATE_PREFIX), c.try_cast("timestamp_ntz"))


def to_contract_type(c: Column, type_name: str, strict: bool = False) -> Column:
    """Cast a text column to a type named in a contract."""
    kind = type_name.upper()
    if kind == "VARCHAR":
        return c
    if kind == "INTEGER":
        return to_integer(c, strict)
    if kind == "TIMESTAMP":
        return to_timestamp(c)
    return c.try_cast(type_name.lower())
