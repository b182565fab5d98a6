"""Scans with stable record ids."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import TableSpec
from ..operators.ordered import Freeze
from .stage import Stages


def read_cells(spark: SparkSession, path: str, cells: Sequence[str], multi_line: bool = True) -> DataFrame:
    """The rows of CSV files, headers among them, every cell as text, quote and escape ``"``.

    ``multi_line=False`` lets Spark split large files when no field holds a line break.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    options = {"header": False, "multiLine": multi_line, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    return spark.read.schema(schema).options(**options).csv(path)


def _headers(landed: DataFrame, firsts: DataFrame, cells: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per file: its path, its column names and the place of each contract column among them."""
    names = F.transform(F.array(*cells), lambda c: F.trim(F.regexp_replace(c, "^\\uFEFF", "")))
    heads = landed.join(firsts.select("_split", F.col("_first").alias("_seq")), ["_split", "_seq"]).select(
        "_file", names.alias("_names")
    )
    places = F.array(*[F.array_position("_names", F.lit(c)).cast("int") for c in columns])
    return heads.select("_file", "_names", places.alias("_places"))


def _check_headers(headers: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a file lacks a column, has one that the contract doesn't know, or has one twice."""
    wanted, named = F.array(*[F.lit(c) for c in columns]), F.filter("_names", lambda c: c.isNotNull())
    twice = F.filter(F.array_distinct(named), lambda c: F.size(F.filter(named, lambda d: d == c)) > 1)
    faults = headers.select(
        "_file",
        F.concat(
            F.transform(F.array_except(wanted, named), lambda c: F.concat(F.lit("missing column "), c)),
            F.transform(F.array_except(named, wanted), lambda c: F.concat(F.lit("extra column "), c)),
            F.transform(twice, lambda c: F.concat(F.lit("column "), c, F.lit(" twice"))),
        ).alias("_faults"),
    ).where(F.size("_faults") > 0)
    found = faults.orderBy("_file").limit(10).collect()
    if found:
        raise ValueError("; ".join(f"{r._file}: {', '.join(r._faults)}" for r in found))


def _unique(keys: DataFrame, key: str) -> bool:
    return keys.select((F.count(key) == F.count_distinct(key)).alias("unique")).first().unique


def land_csv(
    spark: SparkSession, path: str, columns: Sequence[str], freeze: Freeze, label: str, multi_line: bool = True
) -> DataFrame:
    """Load a CSV table once into columnar form, with ``_row_id`` = 1, 2, 3, ... in file order.

    Columns are bound by the header of each file, whatever its order; a missing, unknown or repeated column is an
    error that names file and column.  Spark packs file splits by size, so the order of its partitions is not the
    order of the file.  Rows are numbered inside their split and the sizes of the earlier splits of the same file
    (and of earlier files, by path) are added.  The numbers are frozen before they are used, so a rerun cannot
    shift them.  A split is known by a 64-bit number; should two share one, the table is landed again with others.
    """
    # one cell more than the contract has columns shows a surplus one
    cells = [f"_cell{i}" for i in range(len(columns) + 1)]
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    in_file = Window.partitionBy("_file").orderBy("_block")
    for attempt in itertools.count():
        numbered = read_cells(spark, path, cells, multi_line).select(
            *cells,
            file.alias("_file"),
            block.alias("_block"),
            F.xxhash64(F.lit(attempt), file, block).alias("_split"),
            F.monotonically_increasing_id().alias("_seq"),
        )
        landed = freeze(f"{label}_landed", numbered)
        counted = landed.groupBy("_split", "_file", "_block").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        splits = freeze(f"{label}_splits", counted.withColumn("_place", F.row_number().over(in_file)))
        if _unique(splits, "_split"):
            break
    headers = freeze(f"{label}_headers", _headers(landed, splits.where("_place = 1"), cells, columns))
    _check_headers(headers, columns)
    # the first split of a file starts with the header, which is no row of the table
    head = (F.col("_place") == 1).cast("int")
    splits = splits.select("_split", "_file", "_block", (F.col("_first") + head).alias("_first"), (F.col("_rows") - head).alias("_rows"))
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    by_path = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_file").agg(F.sum("_rows").alias("_file_rows")).select(
        "_file", F.coalesce(F.sum("_file_rows").over(by_path), F.lit(0)).alias("_file_before")
    )
    shift = F.col("_file_before") + F.col("_split_before") - F.col("_first") + 1
    starts = (
        splits.withColumn("_split_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .join(files, "_file")
        .join(headers, "_file")
        .select("_split", "_first", "_places", shift.alias("_shift"))
    )
    rows = landed.join(freeze(f"{label}_starts", starts), "_split").where("_seq >= _first")
    own = [F.get(F.array(*cells), F.get("_places", F.lit(i)) - 1).alias(c) for i, c in enumerate(columns)]
    return rows.select((F.col("_seq") + F.col("_shift")).cast("long").alias("_row_id"), *own)


def with_row_ids(df: DataFrame, freeze: Freeze | None = None, label: str = "scan") -> DataFrame:
    """Add ``_row_id`` (1 = first row) to a Parquet scan: position in the file plus the rows of earlier files.

    The rows of each file are counted once, without reading a column, and written as a table of one row per file;
    scans look their file up in it by a 64-bit number (another set of numbers is taken should two files share one).
    """
    freeze = freeze or Stages(df.sparkSession).freeze
    by_path = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    path = F.col("_metadata.file_path")
    sizes = df.select(path.alias("_path")).groupBy("_path").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(by_path), F.lit(0)).alias("_before")
    for attempt in itertools.count():
        offsets = freeze(f"{label}_offsets", sizes.select(F.xxhash64(F.lit(attempt), "_path").alias("_file"), before))
        if _unique(offsets, "_file"):
            break
    return (
        df.select(F.xxhash64(F.lit(attempt), path).alias("_file"), (F.col("_metadata.row_index") + 1).alias("_place"), "*")
        .join(offsets, "_file")
        .select((F.col("_place") + F.col("_before")).cast("long").alias("_row_id"), *df.columns)
    )


def load_csv_tables(
    spark: SparkSession,
    folder: str,
    contracts: Mapping[str, TableSpec],
    freeze: Freeze,
    files: Mapping[str, str] | None = None,
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Load every contract table from ``folder``; ``files`` maps a table to its file or glob."""
    files = files or {}
    return {
        t: land_csv(spark, f"{folder}/{files.get(t, t + '.csv')}", list(spec.columns), freeze, t, multi_line)
        for t, spec in contracts.items()
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
