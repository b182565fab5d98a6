"""All published figures in one document.

Every section is an aggregated result: one row, or one row per month, bucket, check or listed member.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import count_checks
from . import forecast, kpis, quality, reconcile, star
from .results import ORDERS, positions
from .workbench import Workbench

TOP = 10


def sections(wb: Workbench, models=forecast.ALL) -> dict[str, DataFrame]:
    rec, orders, exc = wb.fact_reconciliation, wb.fact_orders, wb.fact_exceptions
    window = wb.orders_per_month
    held = wb.held_orders.where(F.col("model").isin(*models))
    return {
        "raw_rows": wb.counts,
        "purchase_range": kpis.purchase_range(wb.staged["orders"]),
        "quality": quality.quality_totals(wb.counts, wb.dq),
        "row_status": quality.row_status_counts(wb.counts, wb.dq),
        "headline": kpis.headline(rec),
        "derived": kpis.derived_ratios(rec),
        "categories": kpis.gap_by_category(rec),
        "pareto": kpis.pareto(rec),
        "interest": kpis.interest_rate_card_share(rec),
        "by_installments": reconcile.interest_by_installments(wb.reconciliation),
        "discount_split": kpis.discount_split(wb.reconciliation),
        "missing_items": kpis.missing_items(wb.reconciliation),
        "sequence_gaps": kpis.sequence_gaps(wb.reconciliation, wb.dq),
        "top_states": kpis.top_members(kpis.top_states(rec, wb.dim_customer_state), "state_code", TOP),
        "top_categories": kpis.top_members(kpis.top_categories(rec, wb.dim_product_category), "category_name_en", TOP),
        "payment_mix": kpis.payment_mix(rec, wb.dim_payment_type),
        "exceptions_by_severity": kpis.exceptions_by_severity(exc),
        "exceptions_by_check": kpis.exceptions_by_check(exc),
        "exceptions_per_check_name": kpis.exceptions_per_check_name(exc),
        "delivery": kpis.delivery(orders),
        "reviews_by_match": kpis.reviews_by_match(orders),
        "review_gap": kpis.review_gap(orders),
        "reviews_by_category": kpis.reviews_by_category(orders),
        "monthly": kpis.monthly(rec, orders, exc, wb.dim_date),
        "month_uplift": kpis.month_uplift(wb.orders_per_month),
        "forecast": forecast.run_forecast(window, models, held).drop("series"),
        "forecast_scores": forecast.scores(held).drop("series"),
        "forecast_holdout": held.select("month_start", "model", "kind", "actual", "predicted"),
        "forecast_table": forecast.forecast_table(window, models, held).drop("series"),
        "star_rows": star.star_counts(wb.star),
    }


# sections that are one row by construction
SINGLE = frozenset(
    ("purchase_range", "quality", "headline", "derived", "pareto", "interest", "missing_items", "sequence_gaps", "delivery",
     "review_gap", "forecast")
)


def metric_rows(wb: Workbench, models=forecast.ALL) -> DataFrame:
    """Every figure as (section, record); the record is a JSON object."""
    parts = []
    for name, df in sections(wb, models).items():
        record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record")
        placed = positions(name, df) if name in ORDERS else df.withColumn("position", F.lit(0))
        parts.append(placed.select(F.lit(name).alias("section"), "position", record))
    return reduce(DataFrame.unionByName, parts)


def document(wb: Workbench, models=forecast.ALL) -> dict:
    """The figures as one nested dict, with the contract's own numbers."""
    found: dict[str, list] = {}
    for row in sorted(metric_rows(wb, models).collect(), key=lambda r: (r.section, r.position)):  # aggregated rows only
        found.setdefault(row.section, []).append(json.loads(row.record))
    out = {name: (rows[0] if name in SINGLE else rows) for name, rows in found.items()}
    out["checks_run"] = count_checks(wb.contracts)
    out["match_tolerance"] = float(wb.tolerance)
    out |= totals(out)
    return out


def totals(doc: dict) -> dict:
    """What the sections say as single figures and maps by name."""
    per_check: dict[str, int] = {}
    for row in doc.get("exceptions_by_check", []):
        per_check[row["check_name"]] = per_check.get(row["check_name"], 0) + row["exceptions"]
    first = lambda name: next(iter(doc.get(name, [])), None)
    ahead = [r for r in doc.get("forecast_table", []) if r["row_type"] == "forecast"]
    return {
        "generated_at": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
        "raw_rows_total": sum(r["rows"] for r in doc.get("raw_rows", [])),
        "tables_loaded": len(doc.get("raw_rows", [])),
        "categories_used": len(doc.get("categories", [])),
        "by_category": {r["gap_category"]: r for r in doc.get("categories", [])},
        "top_state": first("top_states"),
        "top_category": first("top_categories"),
        "exceptions_total": sum(per_check.values()),
        "exceptions_by_severity_name": {r["severity"]: r["exceptions"] for r in doc.get("exceptions_by_severity", [])},
        "exceptions_by_check_name": per_check,
        "reviews_by_status": {r["reconciliation_status"]: r for r in doc.get("reviews_by_match", [])},
        "horizon_months": len(ahead),
    }


def write_document(wb: Workbench, path: str, models=forecast.ALL) -> dict:
    doc = document(wb, models)
    text = json.dumps(doc, indent=2, ensure_ascii=False, sort_keys=True)
    wb.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return doc
