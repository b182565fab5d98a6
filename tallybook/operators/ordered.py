"""Numbering and running totals over an order, without a task that holds a whole group.

A plain window keeps one group in one task.  Both methods here cut a group along its order first:

* ``running_total`` cuts at values of a *band* column.  The caller picks a band that bounds the rows per
  (group, band) by construction: a fixed stretch of unique row ids, or a fixed stretch of cents.
* ``ranged_positions`` cuts a whole table into ranges of its sort key, found by Spark's range partitioner.

The totals of the earlier pieces are then added to the position inside each piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Freeze = Callable[[str, DataFrame], DataFrame]

# Rows per band when a band is a stretch of unique row ids.
IDS_PER_BAND = 1 << 20
# Width of a money band: at two decimals it holds at most a million distinct amounts.
MONEY_BAND = 10_000


def id_band(c: Column) -> Column:
    return F.floor(c / F.lit(IDS_PER_BAND)).cast("long")


def value_band(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("long")


def running_total(
    df: DataFrame,
    group: Sequence[str],
    band: Column,
    order: Sequence[Column],
    amount: Column,
    name: str,
    descending: bool = False,
) -> DataFrame:
    """Add ``name``: the inclusive running sum of ``amount`` along ``order`` inside each group.

    ``band`` must follow ``order`` (fall with it when ``descending``), and group columns must not be NULL.
    """
    piece = [*group, "_band"]
    # Spread by (group, band) explicitly: after a join on the group keys alone Spark would count the rows as
    # clustered and leave every band of a hot group in one task.
    cut = df.withColumn("_band", band).withColumn("_amount", amount).repartition(*piece)
    inside = Window.partitionBy(*piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    band_order = F.col("_band").desc() if descending else F.col("_band").asc()
    earlier = Window.partitionBy(*group).orderBy(band_order).rowsBetween(Window.unboundedPreceding, -1)
    # a group that fits one band needs no offset, so this side is nearly always tiny
    before = (
        cut.groupBy(*piece)
        .agg(F.sum("_amount").alias("_total"))
        .select(*piece, F.sum("_total").over(earlier).alias("_before"))
        .where(F.col("_before").isNotNull())
    )
    return (
        cut.withColumn("_inside", F.sum("_amount").over(inside))
        .join(before, piece, "left")
        .withColumn(name, F.col("_inside") + F.coalesce("_before", F.lit(0)))
        .drop("_band", "_amount", "_inside", "_before")
    )


def previous_value(df: DataFrame, group: Sequence[str], band: Column, value: str, name: str, default: int) -> DataFrame:
    """Add ``name``: the next smaller ``value`` of the same group, or ``default`` for the smallest one.

    Rows must be unique on (group, value) and neither may be NULL.
    """
    cut = df.withColumn("_band", band)
    piece = [*group, "_band"]
    inside = Window.partitionBy(*piece).orderBy(value)
    earlier = Window.partitionBy(*group).orderBy("_band")
    last_before = (
        cut.groupBy(*piece)
        .agg(F.max(value).alias("_last"))
        .select(*piece, F.lag("_last", 1).over(earlier).alias("_carried"))
        .where(F.col("_carried").isNotNull())
    )
    return (
        cut.withColumn("_near", F.lag(value, 1).over(inside))
        .join(last_before, piece, "left")
        .withColumn(name, F.coalesce("_near", "_carried", F.lit(default)))
        .drop("_band", "_near", "_carried")
    )


def dense_rank_desc(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """One row per (group, value) with its dense rank, largest value first; ``value`` is money."""
    distinct = df.groupBy(*group, value).agg(F.lit(1).alias("_one")).drop("_one")
    ranked = running_total(
        distinct, group, value_band(F.col(value), MONEY_BAND), [F.col(value).desc()], F.lit(1), name, descending=True
    )
    return ranked.withColumn(name, F.col(name).cast("long"))


def exact_median(df: DataFrame, group: Sequence[str], value: str, width: int, name: str) -> DataFrame:
    """Exact interpolated median per group, from the histogram of the values.

    Counting first keeps equal values together; ``width`` bounds how many distinct values share a band.
    """
    keys = list(group) or ["_all"]
    rows = df.where(F.col(value).isNotNull())
    if not group:
        rows = rows.withColumn("_all", F.lit(0))
    hist = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    hist = hist.withColumn("_band", value_band(F.col(value), width))

    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    low, high = F.floor((F.col("_size") - 1) / 2), F.floor(F.col("_size") / 2)

    def holds(first: Column, n: Column) -> Column:
        """Do ranks first .. first + n - 1 (from 0) contain a middle rank?"""
        return ((first <= low) & (low < first + n)) | ((first <= high) & (high < first + n))

    bands = (
        hist.groupBy(*keys, "_band")
        .agg(F.sum("_n").alias("_in_band"))
        .select(
            *keys, "_band", "_in_band",
            F.sum("_in_band").over(whole).alias("_size"),
            F.coalesce(F.sum("_in_band").over(earlier), F.lit(0)).alias("_before"),
        )
        .where(holds(F.col("_before"), F.col("_in_band")))
        .drop("_in_band")
    )
    # only the one or two bands around the middle are put in order
    inside = Window.partitionBy(*keys, "_band").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    middle = (
        hist.join(bands, [*keys, "_band"])
        .withColumn("_first", F.col("_before") + F.sum("_n").over(inside) - F.col("_n"))
        .where(holds(F.col("_first"), F.col("_n")))
    )
    v = F.col(value).cast("double")
    out = middle.groupBy(*keys).agg((F.min(v) + (F.max(v) - F.min(v)) * 0.5).alias(name))
    return out if group else out.drop("_all")


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged_positions(
    df: DataFrame,
    order: Sequence[Column],
    freeze: Freeze,
    label: str,
    position: str,
    running: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Number a whole table along ``order`` (1, 2, 3, ...), optionally with a running sum.

    The table is range partitioned, sorted and written out with each row's place in its range, so numbering takes one
    shuffle and a lost task can't move rows to other ranges afterwards.  Range totals are one row per range, at most
    ``spark.sql.shuffle.partitions`` of them, so broadcasting them is bounded by a setting and not by the data.

    ``running`` names (amount column, running sum column, grand total column); sums inside a range need its rows together once more.
    """
    cut = df.repartitionByRange(shuffle_width(df), *order).sortWithinPartitions(*order)
    # the id of a row is its partition's number and its place there
    row = F.monotonically_increasing_id()
    place = row.bitwiseAND(F.lit((1 << 33) - 1)) + 1
    frozen = freeze(label, cut.select("*", F.shiftright(row, 33).cast("int").alias("_range"), place.alias("_place")))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    sums = [F.count(F.lit(1)).alias("_rows")]
    offsets = ["_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before")]
    if running:
        sums.append(F.sum(running[0]).alias("_sum"))
        offsets.append(F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"))
        offsets.append(F.sum("_sum").over(Window.partitionBy()).alias(running[2]))
    before = frozen.groupBy("_range").agg(*sums).select(*offsets)

    out = frozen
    if running:
        so_far = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("_part", F.sum(running[0]).over(so_far))
    out = out.join(F.broadcast(before), "_range").withColumn(position, (F.col("_place") + F.col("_rows_before")).cast("long"))
    if running:
        out = out.withColumn(running[1], F.col("_part") + F.col("_sum_before")).drop("_part", "_sum_before")
    return out.drop("_range", "_place", "_rows_before")
