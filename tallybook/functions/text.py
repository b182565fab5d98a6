"""Record keys and date keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "<null>"


def or_null_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NULL_TEXT))


def record_key(cols: Sequence[Column]) -> Column:
    """Composite key as text: parts joined by '|', a missing part shown as '<null>'."""
    return F.concat_ws("|", *[or_null_text(c) for c in cols])


def sentence(*parts: Column | str) -> Column:
    """Concatenate literals and columns into a reason; a missing value never blanks the whole text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else or_null_text(p) for p in parts])


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "MM")
