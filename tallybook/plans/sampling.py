"""Stratified, repeatable sample of orders and every row that belongs to them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checks import hash_filter

# Orders per bucket and rows per failing check.
PER_BUCKET = {
    "matched": 150,
    "missing_items": 8,
    "installment_interest": 8,
    "rounding": 4,
    "untracked_discount": 3,
    "voucher_related": 2,
    "unexplained": 2,
    "missing_payment": 1,
}
PER_CHECK = 3


def first_by_hash(df: DataFrame, group: str, key: str, limit: int) -> DataFrame:
    """``limit`` rows per group in the order of a hash of ``key``.

    Each map task keeps at most ``limit`` rows per group before the shuffle (WindowGroupLimit).
    """
    w = Window.partitionBy(group).orderBy(F.md5(key), key)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def bucket_sample(reconciliation: DataFrame, sizes: Mapping[str, int] = PER_BUCKET) -> DataFrame:
    rows = reconciliation.where(F.col("gap_category").isin(*sizes)).select("gap_category", "order_id")
    size = F.lit(0)
    for name, n in sizes.items():
        size = F.when(F.col("gap_category") == name, n).otherwise(size)
    return first_by_hash(rows, "gap_category", "order_id", max(sizes.values())).where(F.col("place") <= size)


def check_sample(dq: DataFrame, n: int = PER_CHECK) -> DataFrame:
    rows = dq.where(F.col("table_name") == "orders").select("check_name", "record_key", "record_id")
    w = Window.partitionBy("check_name").orderBy(F.md5("record_key"), "record_key", "record_id")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def picked_orders(reconciliation: DataFrame, dq: DataFrame, sizes: Mapping[str, int] = PER_BUCKET, n: int = PER_CHECK) -> DataFrame:
    by_bucket = bucket_sample(reconciliation, sizes).select("order_id")
    by_check = check_sample(dq, n).select(F.col("record_key").alias("order_id"))
    return by_bucket.union(by_check).distinct()


def closure(raw: Mapping[str, DataFrame], picked: DataFrame) -> dict[str, DataFrame]:
    """Rows of all tables that belong to the picked orders, without record ids.

    ``picked`` should be written already.  The fixed sizes of the sample bound it, so a filter of its hashes cuts each table in its scan.
    """
    held = hash_filter(picked, ["order_id"])
    by_order = {t: raw[t].where(held).join(picked, "order_id", "left_semi") for t in ("orders", "order_items", "order_payments", "order_reviews")}
    out = dict(by_order)
    for table, key, user in (
        ("customers", "customer_id", "orders"),
        ("products", "product_id", "order_items"),
        ("sellers", "seller_id", "order_items"),
    ):
        out[table] = raw[table].join(by_order[user].select(key).distinct(), key, "left_semi")
    out["category_translation"] = raw["category_translation"]
    return {t: df.drop("_row_id") for t, df in out.items()}


def closure_counts(raw: Mapping[str, DataFrame], picked: DataFrame) -> DataFrame:
    out = None
    for name, df in closure(raw, picked).items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
