"""KPI queries over the star schema.  Each one is an aggregation to a handful of rows.

Windows here run over aggregated rows (buckets, months, dimension members), never over orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, mean_of_sum, money, pct, ratio
from ..operators.ordered import exact_median
from .quality import exceptions_by, side_by_side
from .reconcile import CLOSED, orders_with_sequence_gap

def _n() -> Column:
    return F.count(F.lit(1))


def _sum_if(cond: Column, c: str) -> Column:
    return F.sum(F.when(cond, F.col(c)))


def _open() -> Column:
    return ~F.col("is_matched")


def _both() -> Column:
    return F.col("expected_total").isNotNull() & F.col("paid_total").isNotNull()


def severity_order() -> Column:
    """1 = high, 2 = medium, 3 = the rest: the sort key of every exception list."""
    return F.when(F.col("severity") == "high", 1).when(F.col("severity") == "medium", 2).otherwise(3)


def headline(rec: DataFrame) -> DataFrame:
    differs = _open() & _both()
    unexplained = F.col("gap_category") == "unexplained"
    high = F.col("severity") == "high"
    t = rec.agg(
        _n().alias("orders_total"),
        F.count_if("in_orders").alias("orders_in_orders_table"),
        F.count_if(_both()).alias("orders_in_both_systems"),
        F.count_if("is_matched").alias("orders_matched"),
        F.count_if(_open()).alias("orders_unmatched"),
        F.count_if(differs).alias("orders_value_mismatch"),
        F.sum("expected_total").alias("sold_brl"),
        F.sum("paid_total").alias("paid_brl"),
        _sum_if(_open(), "abs_gap").alias("abs_gap_brl"),
        _sum_if(_open(), "gap").alias("net_gap_brl"),
        _sum_if(differs, "abs_gap").alias("value_mismatch_abs_gap_brl"),
        F.count_if(unexplained).alias("orders_unexplained"),
        _sum_if(unexplained, "abs_gap").alias("unexplained_abs_gap_brl"),
        F.count_if(high).alias("orders_high_severity"),
        _sum_if(high, "abs_gap").alias("high_severity_abs_gap_brl"),
    )
    return t.select(
        "orders_total", "orders_in_orders_table", "orders_in_both_systems", "orders_matched", "orders_unmatched",
        "orders_value_mismatch",
        pct(F.col("orders_matched"), F.col("orders_total"), 4).alias("match_rate_pct"),
        pct(F.col("orders_matched"), F.col("orders_in_both_systems"), 4).alias("match_rate_both_systems_pct"),
        money(F.col("sold_brl")).alias("sold_brl"),
        money(F.col("paid_brl")).alias("paid_brl"),
        money(F.col("abs_gap_brl")).alias("abs_gap_brl"),
        money(F.col("net_gap_brl")).alias("net_gap_brl"),
        mean_of_sum(F.col("abs_gap_brl"), F.col("orders_unmatched"), 2).alias("avg_abs_gap_brl"),
        money(F.col("value_mismatch_abs_gap_brl")).alias("value_mismatch_abs_gap_brl"),
        mean_of_sum(F.col("value_mismatch_abs_gap_brl"), F.col("orders_value_mismatch"), 2).alias("value_mismatch_avg_abs_gap_brl"),
        "orders_unexplained",
        money(F.col("unexplained_abs_gap_brl")).alias("unexplained_abs_gap_brl"),
        "orders_high_severity",
        money(F.col("high_severity_abs_gap_brl")).alias("high_severity_abs_gap_brl"),
    )


def gap_by_category(rec: DataFrame) -> DataFrame:
    """Unmatched orders per bucket; shares are of the unmatched orders and of their gap."""
    g = rec.where(_open()).groupBy("gap_category").agg(
        F.array_join(F.array_sort(F.collect_set("severity")), "/").alias("severity"),
        _n().alias("orders"),
        F.sum("abs_gap").alias("abs_gap_brl"),
        F.sum("gap").alias("net_gap_brl"),
    )
    every = Window.partitionBy()
    return g.select(
        "gap_category",
        "severity",
        "orders",
        pct(F.col("orders"), F.sum("orders").over(every), 4).alias("share_of_orders_pct"),
        money(F.col("abs_gap_brl")).alias("abs_gap_brl"),
        money(F.col("net_gap_brl")).alias("net_gap_brl"),
        mean_of_sum(F.col("abs_gap_brl"), F.col("orders"), 2).alias("avg_abs_gap_brl"),
        pct(F.col("abs_gap_brl"), F.sum("abs_gap_brl").over(every), 2).alias("share_of_unmatched_gap_pct"),
    )


def pareto(rec: DataFrame) -> DataFrame:
    """Unmatched orders that hold 80 % of the gap.

    ``orders_for_80pct_of_gap`` counts shares up to 0.8 and adds one, as published; it is one too high when a
    share is exactly 0.8 and 1 when nothing is unmatched.  ``orders_for_80pct_exact`` has neither flaw.
    """
    below = F.count_if(F.col("cumulative_gap_share") < 0.8)
    return rec.where(_open()).agg(
        (F.count_if(F.col("cumulative_gap_share") <= 0.8) + 1).alias("orders_for_80pct_of_gap"),
        _n().alias("unmatched_orders"),
        F.when(_n() > 0, below + 1).otherwise(0).cast("long").alias("orders_for_80pct_exact"),
    )


def exceptions_by_check(exc: DataFrame) -> DataFrame:
    return exceptions_by(exc, "source", "table_name", "check_name", "severity")


def exceptions_by_severity(exc: DataFrame) -> DataFrame:
    return exc.groupBy("severity").agg(
        _n().alias("exceptions"),
        F.count_if(F.col("source") == "data_quality").alias("data_quality"),
        F.count_if(F.col("source") == "reconciliation").alias("reconciliation"),
    )


def monthly(rec: DataFrame, orders: DataFrame, exc: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, matching, gap, exceptions and delivery per purchase month.

    Facts shrink to one row per purchase day before they meet the calendar.
    """
    month = dates.select(F.col("date_key").alias("purchase_date_key"), "month_start")

    def per_month(daily: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in daily.columns if c != "purchase_date_key"]
        return daily.join(month, "purchase_date_key").groupBy("month_start").agg(*sums)

    r = per_month(
        rec.groupBy("purchase_date_key").agg(
            _n().alias("orders"),
            F.count_if("is_matched").alias("matched"),
            F.count_if(_open()).alias("unmatched"),
            _sum_if(_open(), "abs_gap").alias("abs_gap_brl"),
            F.sum("expected_total").alias("sold_brl"),
        )
    )
    d = per_month(
        orders.groupBy("purchase_date_key").agg(
            F.count_if("is_delivered").alias("delivered"), F.count_if("is_on_time").alias("on_time")
        )
    )
    e = per_month(exc.groupBy("purchase_date_key").agg(_n().alias("exceptions")))
    return (
        r.join(d, "month_start", "left")
        .join(e, "month_start", "left")
        .select(
            F.date_format("month_start", "yyyy-MM").alias("month"),
            "orders",
            "matched",
            "unmatched",
            pct(F.col("matched"), F.col("orders"), 2).alias("match_rate_pct"),
            money(F.coalesce("abs_gap_brl", F.lit(0))).alias("abs_gap_brl"),
            money(F.col("sold_brl")).alias("sold_brl"),
            F.coalesce("exceptions", F.lit(0)).alias("exceptions"),
            "delivered",
            pct(F.col("on_time"), F.col("delivered"), 2).alias("on_time_rate_pct"),
        )
    )


def _by_member(rec: DataFrame, key: str) -> DataFrame:
    """Orders, unmatched orders and their gap per dimension key, before any dimension is joined."""
    return rec.groupBy(key).agg(
        _n().alias("orders"), F.count_if(_open()).alias("unmatched"), _sum_if(_open(), "abs_gap").alias("abs_gap_brl")
    )


def _rates(df: DataFrame, *names: str, rank: bool) -> DataFrame:
    cols = [
        *names,
        "orders",
        "unmatched",
        pct(F.col("unmatched"), F.col("orders"), 2).alias("unmatched_rate_pct"),
        money(F.coalesce("abs_gap_brl", F.lit(0))).alias("abs_gap_brl"),
    ]
    if rank:
        cols.append(F.rank().over(Window.orderBy(F.col("unmatched").desc())).cast("long").alias("rank_by_unmatched"))
    return df.select(*cols)


def top_states(rec: DataFrame, states: DataFrame) -> DataFrame:
    return _rates(_by_member(rec, "state_code").join(states, "state_code"), "state_code", "state_name", "region", rank=True)


def top_categories(rec: DataFrame, categories: DataFrame) -> DataFrame:
    """Only orders with items: without items there is no category to blame."""
    named = (
        _by_member(rec.where(F.col("item_count").isNotNull()), "category_key")
        .join(categories, "category_key")
        .groupBy("category_name_en")
        .agg(F.sum("orders").alias("orders"), F.sum("unmatched").alias("unmatched"), F.sum("abs_gap_brl").alias("abs_gap_brl"))
    )
    return _rates(named, "category_name_en", rank=True)


def payment_mix(rec: DataFrame, kinds: DataFrame) -> DataFrame:
    return _rates(_by_member(rec, "payment_type").join(kinds, "payment_type"), "payment_type", "description", rank=False)


def delivery(orders: DataFrame) -> DataFrame:
    late = F.col("is_on_time") == F.lit(False)
    score = F.col("review_score")

    def mean_score(cond: Column) -> Column:
        return half_up(F.avg(F.when(cond, score)), 3)

    t = orders.agg(
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if("is_on_time").alias("on_time_orders"),
        F.count_if(late).alias("late_orders"),
        mean_score(F.col("is_on_time")).alias("avg_review_on_time"),
        mean_score(late).alias("avg_review_late"),
    )
    mid = exact_median(orders, [], "delivery_days", 10_000, "_mid")
    both = side_by_side(t, mid)
    return both.select(
        "delivered_orders",
        "on_time_orders",
        "late_orders",
        pct(F.col("on_time_orders"), F.col("delivered_orders"), 2).alias("on_time_rate_pct"),
        pct(F.col("late_orders"), F.col("delivered_orders"), 2).alias("late_rate_pct"),
        half_up(F.col("_mid"), 1).alias("median_delivery_days"),
        "avg_review_on_time",
        "avg_review_late",
    )


def reviews_by_match(orders: DataFrame) -> DataFrame:
    """Review scores of matched and unmatched orders.

    ``pct_reviews_1_or_2`` is the share of reviewed orders whose mean score is at most 2, not of reviews.
    """
    t = (
        orders.where(F.col("is_matched").isNotNull())
        .groupBy(F.when(F.col("is_matched"), "matched").otherwise("unmatched").alias("reconciliation_status"))
        .agg(
            _n().alias("orders"),
            F.count("review_score").alias("orders_with_review"),
            half_up(F.avg("review_score"), 3).alias("avg_review_score"),
            F.count_if(F.col("review_score") <= 2).alias("_poor"),
        )
    )
    return t.withColumn("pct_reviews_1_or_2", pct(F.col("_poor"), F.col("orders_with_review"), 2)).drop("_poor")


def reviews_by_category(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("gap_category").isNotNull()).groupBy("gap_category").agg(
        _n().alias("orders"),
        F.count("review_score").alias("orders_with_review"),
        half_up(F.avg("review_score"), 3).alias("avg_review_score"),
    )


def interest_rate_card_share(rec: DataFrame) -> DataFrame:
    """Interest orders whose paid/sold ratio is shared by at least three orders (grain: ratio only)."""
    per_ratio = (
        rec.where(F.col("gap_category") == "installment_interest").groupBy("paid_to_sold_ratio").agg(_n().alias("n"))
    )
    shared = F.col("n") >= 3
    t = per_ratio.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("interest_orders"),
        F.coalesce(F.sum(F.when(shared, F.col("n"))), F.lit(0)).cast("long").alias("on_shared_ratio"),
        F.count_if(shared & F.col("paid_to_sold_ratio").isNotNull()).alias("shared_ratios"),
    )
    return t.select(
        "interest_orders",
        "on_shared_ratio",
        pct(F.col("on_shared_ratio"), F.col("interest_orders"), 2).alias("on_shared_ratio_pct"),
        "shared_ratios",
    )


def discount_split(rec: DataFrame) -> DataFrame:
    return (
        rec.where(F.col("gap_category") == "untracked_discount")
        .groupBy("main_payment_type", pct(-F.col("gap"), F.col("product_value"), 0).alias("discount_pct"))
        .agg(_n().alias("orders"))
    )


def missing_items(rec: DataFrame) -> DataFrame:
    closed = F.col("order_status").isin(*CLOSED)
    t = rec.where(F.col("gap_category") == "missing_items").agg(
        _n().alias("orders"),
        money(F.sum("paid_total")).alias("paid_brl"),
        F.count_if(closed).alias("canceled_or_unavailable"),
        money(_sum_if(closed, "paid_total")).alias("canceled_or_unavailable_brl"),
        F.count_if(~closed).alias("open_orders"),
        money(_sum_if(~closed, "paid_total")).alias("open_orders_brl"),
    )
    return t.withColumn("canceled_or_unavailable_pct", pct(F.col("canceled_or_unavailable"), F.col("orders"), 2))


def sequence_gaps(rec: DataFrame, dq: DataFrame) -> DataFrame:
    return orders_with_sequence_gap(rec, dq).agg(
        _n().alias("orders_with_sequence_gap"), F.count_if("is_matched").alias("still_matched")
    )


# ---- derived figures -----------------------------------------------------------------------------------


def derived_ratios(rec: DataFrame) -> DataFrame:
    """Ratios built on the headline: gap of paid, explained, interest and discount, unexplained, Pareto share.

    ``orphans_in_both_systems`` shows how many 'explained' orders are orphans with both totals.
    """
    h = headline(rec).select("abs_gap_brl", "paid_brl", "orders_value_mismatch", "orders_unexplained", "orders_total")
    name = F.col("gap_category")
    parts = rec.where(_open()).agg(
        F.count_if(name.isin("installment_interest", "untracked_discount")).alias("_interest_discount"),
        F.count_if((name == "orphan_no_order") & _both()).alias("orphans_in_both_systems"),
    )
    both = side_by_side(h, parts, pareto(rec))
    mismatch = F.col("orders_value_mismatch")
    explained = mismatch - F.col("orders_unexplained")
    return both.select(
        pct(F.col("abs_gap_brl"), F.col("paid_brl"), 3).alias("abs_gap_pct_of_paid"),
        explained.alias("value_mismatch_explained"),
        pct(explained, mismatch, 2).alias("value_mismatch_explained_pct"),
        pct(F.col("_interest_discount"), mismatch, 2).alias("interest_and_discount_pct_of_value_mismatch"),
        pct(F.col("orders_unexplained"), F.col("orders_total"), 4).alias("unexplained_pct_of_orders"),
        pct(F.col("orders_for_80pct_of_gap"), F.col("unmatched_orders"), 1).alias("pareto_pct_of_unmatched_orders"),
        "orphans_in_both_systems",
    )


def interest_medians(by_installments: DataFrame, counts: tuple[int, ...] = (2, 12)) -> DataFrame:
    """Median overpayment at chosen installment counts."""
    return by_installments.where(F.col("max_installments").isin(*counts)).select("max_installments", "median_gap_pct")


def review_gap(orders: DataFrame) -> DataFrame:
    """Mean review of matched orders minus that of unmatched orders, from the published (rounded) means."""
    by = reviews_by_match(orders)
    status = F.col("reconciliation_status")
    matched = F.max(F.when(status == "matched", F.col("avg_review_score")))
    unmatched = F.max(F.when(status == "unmatched", F.col("avg_review_score")))
    return by.agg(matched.alias("avg_review_matched"), unmatched.alias("avg_review_unmatched")).withColumn(
        "review_gap_matched_minus_unmatched", half_up(F.col("avg_review_matched") - F.col("avg_review_unmatched"), 2)
    )


def month_uplift(orders_per_month: DataFrame) -> DataFrame:
    """Orders of a month over the month before, in percent, for every calendar month of the series."""
    w = Window.orderBy("month_start")
    before = F.lag("orders").over(w)
    return orders_per_month.select(
        "month_start", "orders", half_up(F.lit(100.0) * (ratio(F.col("orders"), before) - 1), 1).alias("uplift_pct")
    )


def exceptions_per_check_name(exc: DataFrame) -> DataFrame:
    return exceptions_by(exc, "check_name")


def purchase_range(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.min("order_purchase_timestamp").cast("date").alias("first_purchase_date"),
        F.max("order_purchase_timestamp").cast("date").alias("last_purchase_date"),
    )


# ---- extracts ------------------------------------------------------------------------------------------


def exception_detail(exc: DataFrame) -> DataFrame:
    """Every exception, most severe first."""
    return exc.select(
        "exception_id", "source", "table_name", "record_key", "check_name", "severity", "reason"
    ).orderBy(severity_order(), "source", "check_name", F.col("record_key").asc_nulls_last(), "exception_id")


def unmatched_detail(rec: DataFrame, ranked: DataFrame) -> DataFrame:
    """Unmatched orders with ranks, largest gap first."""
    ranks = ranked.select("order_id", "overall_rank")
    return (
        rec.where(_open())
        .join(ranks, "order_id")
        .select(
            "overall_rank", "order_id", "order_status", "purchase_date_key", "state_code", "payment_types",
            "max_installments", "expected_total", "paid_total", "gap", "abs_gap", "gap_pct", "gap_category", "severity",
            "gap_rank_in_month", "gap_rank_in_state",
            half_up(F.col("cumulative_gap_share") * 100, 2).alias("cumulative_gap_share_pct"),
        )
        .orderBy("overall_rank")
    )


def largest_gaps(rec: DataFrame, n: int = 15) -> DataFrame:
    return (
        rec.where(_open())
        .orderBy(F.col("abs_gap").desc(), "order_id")
        .limit(n)
        .select("order_id", "order_status", "gap_category", "severity", "expected_total", "paid_total", "gap")
    )


def top_members(ranked: DataFrame, key: str, n: int = 10) -> DataFrame:
    """First n rows of a ranked KPI, by unmatched orders, then orders, then name."""
    return ranked.orderBy(F.col("unmatched").desc(), F.col("orders").desc(), key).limit(n)
