"""Report measures over the star schema, sliced by any dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up, mean_of_sum, money, pct, ratio

Star = Mapping[str, DataFrame]

# dimension attribute -> (dimension, key in the dimension, key in the fact)
ATTRIBUTES = {
    **{a: ("dim_date", "date_key", "purchase_date_key") for a in ("year", "quarter", "year_month", "month_start", "is_weekend")},
    **{a: ("dim_customer_state", "state_code", "state_code") for a in ("state_name", "region")},
    **{a: ("dim_payment_type", "payment_type", "payment_type") for a in ("description", "is_card")},
    **{a: ("dim_product_category", "category_key", "category_key") for a in ("category_name_en",)},
}


def _sliced(star: Star, fact: str, by: Sequence[str], sums: Mapping[str, Column], date: str = "purchase_date_key") -> DataFrame:
    """Sum ``sums`` by dimension attributes and fact columns.

    The fact is first reduced to one row per combination of the keys in use, then meets the dimensions.  Facts
    without a dimension row keep a blank member (left join).
    """
    df = star[fact]
    lookups: dict[tuple[str, str, str], list[str]] = {}
    keys: list[str] = []
    for a in by:
        if a in df.columns and a not in ATTRIBUTES:
            keys.append(a)
            continue
        dim, dim_key, fact_key = ATTRIBUTES[a]
        fact_key = date if dim == "dim_date" else fact_key
        lookups.setdefault((dim, dim_key, fact_key), []).append(a)
        keys.append(fact_key)
    small = df.groupBy(*dict.fromkeys(keys)).agg(*[c.alias(n) for n, c in sums.items()])
    for (dim, dim_key, fact_key), attrs in lookups.items():
        members = star[dim].select(F.col(dim_key).alias(fact_key), *[F.col(a) for a in attrs])
        small = small.join(members, fact_key, "left")
    return small.groupBy(*by).agg(*[F.sum(n).alias(n) for n in sums])


def _n_if(c: Column) -> Column:
    return F.count_if(c)


def _sum_if(c: Column, what: str) -> Column:
    return F.sum(F.when(c, F.col(what)))


def related(star: Star, fact: str, by: Sequence[str]) -> bool:
    """Can every attribute reach this fact?"""
    cols = star[fact].columns
    return all(a in cols or (a in ATTRIBUTES and ATTRIBUTES[a][2] in cols) for a in by)


def measures(star: Star, by: Sequence[str]) -> DataFrame:
    """The report measures for each combination of ``by``; a measure whose fact has no such key is NULL."""
    open_ = ~F.col("is_matched")
    parts = [
        _sliced(star, "fact_reconciliation", by, {
            "orders": F.count(F.lit(1)),
            "unmatched": _n_if(open_),
            "abs_gap": _sum_if(open_, "abs_gap"),
            "paid_no_items": _sum_if(F.col("gap_category") == "missing_items", "paid_total"),
        })
    ]
    if related(star, "fact_orders", by):
        parts.append(_sliced(star, "fact_orders", by, {"delivered": _n_if(F.col("is_delivered")), "on_time": _n_if(F.col("is_on_time"))}))
    if related(star, "fact_exceptions", by):
        parts.append(_sliced(star, "fact_exceptions", by, {"high": _n_if(F.col("severity") == "high")}))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for c in ("delivered", "on_time", "high"):
        if c not in stacked.columns:
            stacked = stacked.withColumn(c, F.lit(None).cast("long"))
    names = ("orders", "unmatched", "abs_gap", "paid_no_items", "delivered", "on_time", "high")
    t = stacked.groupBy(*by).agg(*[F.sum(c).alias(f"_{c}") for c in names])
    orders = F.coalesce("_orders", F.lit(0))
    unmatched = F.coalesce("_unmatched", F.lit(0))
    gap = F.coalesce("_abs_gap", F.lit(0))
    return t.select(
        *by,
        orders.alias("orders_reconciled"),
        unmatched.alias("unmatched_orders"),
        pct(orders - unmatched, orders, 4).alias("match_rate_pct"),
        money(gap).alias("total_abs_gap_brl"),
        mean_of_sum(gap, unmatched, 2).alias("avg_gap_per_unmatched_brl"),
        money(F.coalesce("_paid_no_items", F.lit(0))).alias("paid_with_no_items_brl"),
        F.col("_high").alias("high_severity_exceptions"),
        pct(F.col("_on_time"), F.col("_delivered"), 4).alias("on_time_delivery_pct"),
    )


def match_rate_change(star: Star) -> DataFrame:
    """Match rate per month and its change against the calendar month before, in percentage points."""
    months = (
        _sliced(star, "fact_reconciliation", ["month_start"], {"orders": F.count(F.lit(1)), "matched": _n_if(F.col("is_matched"))})
        .where(F.col("month_start").isNotNull())
        .select("month_start", ratio(F.col("matched"), F.col("orders")).alias("rate"))
    )
    before = months.select(F.add_months("month_start", 1).alias("month_start"), F.col("rate").alias("rate_before"))
    return months.join(before, "month_start", "left").select(
        "month_start",
        half_up(F.col("rate") * 100.0, 4).alias("match_rate_pct"),
        half_up((F.col("rate") - F.col("rate_before")) * 100.0, 4).alias("change_pp"),
    )


def review_by_flag(orders: DataFrame) -> DataFrame:
    """Mean order review by match flag and by on-time flag, as one list."""

    def by(flag: str) -> DataFrame:
        return orders.groupBy(F.col(flag).alias("value")).agg(
            F.count("review_score").alias("orders_with_review"), half_up(F.avg("review_score"), 3).alias("avg_review_score")
        ).select(F.lit(flag).alias("flag"), "value", "orders_with_review", "avg_review_score")

    return by("is_matched").unionByName(by("is_on_time"))


def severity_matrix(rec: DataFrame) -> DataFrame:
    """Unmatched orders and their gap: buckets down, severities across."""
    return (
        rec.where(~F.col("is_matched"))
        .groupBy("gap_category")
        .pivot("severity", ["high", "medium", "low"])
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("abs_gap").cast("decimal(38,2)").alias("abs_gap_brl"))
    )


def exceptions_by_month_and_source(star: Star) -> DataFrame:
    """Exceptions per purchase month, one column per source; the blank month holds those without an order."""
    return (
        _sliced(star, "fact_exceptions", ["month_start", "source"], {"n": F.count(F.lit(1))})
        .groupBy("month_start")
        .pivot("source", ["data_quality", "reconciliation"])
        .agg(F.sum("n"))
        .select(
            "month_start",
            F.coalesce("data_quality", F.lit(0)).alias("data_quality"),
            F.coalesce("reconciliation", F.lit(0)).alias("reconciliation"),
        )
    )


DRILL_PATH = ("gap_category", "region", "state_name", "payment_type", "order_status")


def drill_down(star: Star) -> DataFrame:
    """Gap of unmatched orders at every depth of the drill path; ``depth`` 0 is the total.

    The rollup expands rows, so it runs over the combinations that occur and not over the orders.
    """
    open_only = {**star, "fact_reconciliation": star["fact_reconciliation"].where(~F.col("is_matched"))}
    cube = _sliced(open_only, "fact_reconciliation", DRILL_PATH, {"orders": F.count(F.lit(1)), "abs_gap": F.sum("abs_gap")})
    level = F.lit(len(DRILL_PATH))
    for c in DRILL_PATH:
        level = level - F.grouping(c)
    return cube.rollup(*DRILL_PATH).agg(
        level.cast("int").alias("depth"), F.sum("orders").alias("orders"), money(F.sum("abs_gap")).alias("abs_gap_brl")
    )


def by_delivery_month(star: Star) -> DataFrame:
    """Delivered orders and on-time share by month of delivery instead of purchase."""
    t = _sliced(
        star, "fact_orders", ["month_start"],
        {"delivered_orders": F.count(F.lit(1)), "on_time_orders": _n_if(F.col("is_on_time"))},
        date="delivered_date_key",
    ).where(F.col("month_start").isNotNull())
    return t.withColumn("on_time_rate_pct", pct(F.col("on_time_orders"), F.col("delivered_orders"), 2))
