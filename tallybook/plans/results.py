"""Declared order of every named result that is handed out.

Keys are columns, ``-`` in front for descending, ``severity`` by rank.  The last keys make the order total.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kpis import severity_order

ORDERS = {
    "rounding_by_item_count": ("item_count",),
    "interest_rate_card": ("max_installments", "-orders", "paid_to_sold_ratio"),
    "interest_by_installments": ("max_installments",),
    "discount_share_of_price": ("discount_pct_of_price", "order_id"),
    "missing_items_by_status": ("-orders", "order_status"),
    "sequence_gap_orders_reconcile": ("-orders", "gap_category"),
    "voucher_orders": ("-abs_gap", "order_id"),
    "reconciliation_summary": ("-orders", "gap_category"),
    "exceptions_summary": ("severity", "-exceptions", "source", "table_name", "check_name"),
    "gap_by_category": ("-abs_gap_brl", "gap_category"),
    "categories": ("-abs_gap_brl", "gap_category"),
    "exceptions_by_check": ("severity", "-exceptions", "source", "table_name", "check_name"),
    "exceptions_by_severity": ("severity",),
    "row_status": ("-rows_in", "table_name"),
    "monthly": ("month",),
    "top_states": ("-unmatched", "-orders", "state_code"),
    "top_categories": ("-unmatched", "-orders", "category_name_en"),
    "reviews_by_match": ("reconciliation_status",),
    "reviews_by_category": ("-orders", "gap_category"),
    "payment_mix": ("-orders", "payment_type"),
    "discount_split": ("main_payment_type", "discount_pct"),
    "by_installments": ("max_installments",),
    "month_uplift": ("month_start",),
    "forecast_table": ("row_type", "month_start", "model"),
    "star_rows": ("table_name",),
    "raw_rows": ("table_name",),
}


def order_keys(name: str, df: DataFrame) -> list[Column]:
    """The sort columns declared for ``name``; NULLs last."""

    def key(k: str) -> Column:
        if k == "severity":
            return severity_order()
        if k == "-abs_gap" and "abs_gap" not in df.columns:
            return F.abs("gap").desc_nulls_last()
        return F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()

    return [key(k) for k in ORDERS[name]]


def in_order(name: str, df: DataFrame) -> DataFrame:
    """``df`` in the order declared for ``name``.  Spark sorts by ranges, so part files are in order, too."""
    return df.orderBy(*order_keys(name, df))


def positions(name: str, df: DataFrame) -> DataFrame:
    """``df`` with ``position`` (from 1) in the order declared for ``name``.  For results of a few members, months or checks."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order_keys(name, df))))


def described(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of output tables as a table: table_name, position, column_name, data_type."""
    rows = [(t, n, f.name, f.dataType.simpleString()) for t, df in tables.items() for n, f in enumerate(df.schema.fields, 1)]
    return next(iter(tables.values())).sparkSession.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")
