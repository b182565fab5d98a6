"""Exports and read-back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Each row as one JSON object per line."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read an exported CSV back with inferred types; values may hold line breaks, so a part file is read as one."""
    options = {"header": True, "inferSchema": True, "multiLine": True, "quote": '"', "escape": '"'}
    return spark.read.options(**options).csv(path)


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Every table as zstd Parquet and as CSV with header, one folder per table and format."""
    for name, df in tables.items():
        write_parquet(df, f"{folder}/{name}.parquet")
        write_csv(df, f"{folder}/{name}.csv")


def copy_parity(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Rows of the Parquet and the CSV copy of each exported table, side by side."""
    out = None
    for n in names:
        p = spark.read.parquet(f"{folder}/{n}.parquet").agg(F.count(F.lit(1)).alias("parquet_rows"))
        c = read_csv(spark, f"{folder}/{n}.csv").agg(F.count(F.lit(1)).alias("csv_rows"))
        one = p.withColumn("table_name", F.lit(n)).join(c.withColumn("table_name", F.lit(n)), "table_name")
        out = one if out is None else out.unionByName(one)
    return out
