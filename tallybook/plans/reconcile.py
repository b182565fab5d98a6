"""Sold against paid, one row per order: totals, bucket, severity, rankings, evidence."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_up, money, pct, ratio
from ..functions.text import month_start, or_null_text, sentence
from ..operators.checks import HOT_ROWS, hot_hashes
from ..operators.ordered import Freeze, dense_rank_desc, exact_median, ranged_positions
from .quality import QUARANTINE, side_by_side

Tables = Mapping[str, DataFrame]

TOLERANCE = "0.01"
CLOSED = ("canceled", "unavailable")
HEADER = (
    "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)


def first_rows(df: DataFrame, key: str) -> DataFrame:
    """First row per key.  Spark keeps one row per key in each map task before it shuffles (WindowGroupLimit)."""
    w = Window.partitionBy(key).orderBy("_row_id")
    return df.where(F.col(key).isNotNull()).withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def left_join_spread(rows: DataFrame, known: DataFrame, key: str, by: str) -> DataFrame:
    """Left join on ``key`` in which rows without a key, which match nothing, are dealt over all partitions by ``by``."""
    none = F.pmod(F.xxhash64(key), F.lit(1))  # 0, but no constant: Spark would take that out of the join keys
    spread = F.when(F.col(key).isNull(), F.xxhash64(by)).otherwise(none)
    return rows.withColumn("_spread", spread).join(known.withColumn("_spread", none), [key, "_spread"], "left").drop("_spread")


def _last_if_null(c: Column) -> list[Column]:
    """Order keys for a struct comparison: NULLs after all values."""
    return [c.isNull(), c]


def _dearest_first(row: str, amount: str, number: str) -> Column:
    """Largest amount first, then the lowest number, then the first row; NULL where there is no such row."""
    value, n = F.col(f"{row}.{amount}"), F.col(f"{row}.{number}")
    return F.when(F.col(row).isNotNull(), F.struct(value.isNull(), -value, *_last_if_null(n), F.col(f"{row}._row_id")))


def _sources(staged: Tables, flagged: DataFrame) -> DataFrame:
    """Headers, items, payments, reviews and quality flags stacked into one narrow table keyed by order."""
    people = first_rows(staged["customers"], "customer_id").select("customer_id", "customer_state")
    headers = left_join_spread(staged["orders"], people, "customer_id", "_row_id").select(
        "order_id", F.struct("_row_id", *HEADER, "customer_state").alias("o")
    )
    items = staged["order_items"].select("order_id", F.struct("price", "freight_value", "product_id", "order_item_id", "_row_id").alias("i"))
    payments = staged["order_payments"].select(
        "order_id", F.struct("payment_type", "payment_installments", "payment_value", "payment_sequential", "_row_id").alias("p")
    )
    # a contract may have no reviews: the scores are then unknown
    reviews = (
        staged["order_reviews"].select("order_id", F.struct("review_score").alias("r"))
        if "order_reviews" in staged
        else staged["orders"].select("order_id", F.struct(F.lit(None).cast("int").alias("review_score")).alias("r")).where(F.lit(False))
    )
    flags = flagged.select("order_id", F.lit(True).alias("dq"))
    parts = [headers, items, payments, reviews, flags]
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [p.where(F.col("order_id").isNotNull()) for p in parts],
    )


#: Payment types that fit the bits of a number.
TYPE_BITS = 63


def _type_set(payments: DataFrame) -> tuple[Column, Callable[[Column], Column]]:
    """The set of an order's payment types: the aggregate that gathers it, and its text.

    As long as the table has few types, the set is a number with one bit a type, which needs no sets of texts while it is aggregated.
    """
    kinds = payments.where(F.col("payment_type").isNotNull()).select("payment_type").distinct().limit(TYPE_BITS + 1).collect()
    if len(kinds) > TYPE_BITS:
        return F.collect_set("p.payment_type"), lambda kept: F.array_join(F.array_sort(kept), "+")
    names = sorted((r.payment_type for r in kinds), key=lambda name: name.encode())
    one = F.lit(1).cast("long")
    place = F.array_position(F.array(*map(F.lit, names)), F.col("p.payment_type")).cast("int") if names else F.lit(None).cast("int")
    bits = F.bit_or(F.call_function("shiftleft", one, place - 1))

    def text(kept: Column) -> Column:
        seen = [F.when(F.getbit(kept, F.lit(i)) == 1, name) for i, name in enumerate(names)]
        return F.array_join(F.array(*seen), "+") if seen else F.lit("")

    return bits, text


def order_ledger(staged: Tables, dq: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Everything known about an order id, one row per id seen in orders, items or payments.

    Instead of one shuffle and join per source, the sources are stacked and aggregated once by ``order_id``, and no table
    is read twice.  Rows of an order come from all parts of the tables, so they are brought together as they are; combining them in
    the map tasks would sort every row once more.  Orders with more than ``hot_rows`` rows are told apart by a count, and those are
    reduced in the map tasks.
    """
    flagged = dq.where(
        F.col("severity").isin(*QUARANTINE) & F.col("table_name").isin("orders", "order_items", "order_payments")
    )
    rows = _sources(staged, flagged)
    counted = [staged[t] for t in ("orders", "order_items", "order_payments", "order_reviews") if t in staged] + [flagged]
    ids = reduce(DataFrame.unionAll, [t.select("order_id") for t in counted]).where(F.col("order_id").isNotNull())
    hash_ = F.xxhash64("order_id")
    hot = hot_hashes(ids, hash_, hot_rows)
    kinds, kinds_text = _type_set(staged["order_payments"])

    def per_order(some: DataFrame) -> DataFrame:
        return some.groupBy("order_id").agg(
            F.min_by("o", "o._row_id").alias("o"),
            F.count("i").alias("items"),
            F.sum("i.price").alias("product_value"),
            F.sum("i.freight_value").alias("freight_value"),
            F.sum(F.col("i.price") + F.col("i.freight_value")).alias("expected_total"),
            F.min_by("i.product_id", _dearest_first("i", "price", "order_item_id")).alias("main_product_id"),
            F.count("p").alias("payments"),
            F.sum("p.payment_value").alias("paid_total"),
            F.max("p.payment_installments").alias("max_installments"),
            F.bool_or(F.col("p.payment_type") == "voucher").alias("has_voucher"),
            F.bool_and(F.col("p.payment_type") == "credit_card").alias("only_credit_card"),
            kinds.alias("kinds"),
            F.min_by("p.payment_type", _dearest_first("p", "payment_value", "payment_sequential")).alias("main_payment_type"),
            F.count("r").alias("review_count"),
            F.sum("r.review_score").alias("score_sum"),
            F.count("r.review_score").alias("score_count"),
            F.bool_or("dq").alias("dq"),
        )

    is_hot = hash_.isin(hot) if hot else F.lit(False)
    row = per_order(rows.where(~is_hot).repartition("order_id"))
    if hot:
        row = row.unionByName(per_order(rows.where(is_hot)))
    row = row.withColumn("payment_types", F.nullif(kinds_text(F.col("kinds")), F.lit("")))
    known = row.where(F.col("o").isNotNull() | (F.col("items") > 0) | (F.col("payments") > 0))
    category = first_rows(staged["products"], "product_id").select(
        F.col("product_id").alias("main_product_id"), "product_category_name"
    )
    none = F.lit(0)
    return left_join_spread(known, category, "main_product_id", "order_id").select(
        "order_id",
        F.col("o").isNotNull().alias("in_orders"),
        F.col("o._row_id").alias("header_row_id"),
        *[F.col(f"o.{c}").alias(c) for c in HEADER],
        F.col("o.customer_state").alias("customer_state"),
        F.nullif("items", none).alias("item_count"),
        money(F.col("product_value")).alias("product_value"),
        money(F.col("freight_value")).alias("freight_value"),
        money(F.col("expected_total")).alias("expected_total"),
        F.coalesce("product_category_name", F.lit("unknown")).alias("category_key"),
        F.nullif("payments", none).alias("payment_count"),
        money(F.col("paid_total")).alias("paid_total"),
        "payment_types",
        "main_payment_type",
        "max_installments",
        F.coalesce("has_voucher", F.lit(False)).alias("has_voucher"),
        F.coalesce("only_credit_card", F.lit(False)).alias("only_credit_card"),
        ratio(F.col("score_sum"), F.col("score_count")).alias("review_score"),
        "review_count",
        F.coalesce("dq", F.lit(False)).alias("has_dq_exception"),
    )


def order_totals(ledger: DataFrame) -> DataFrame:
    """Both totals of an order, their gap and its ratios."""
    zero = F.lit(0).cast("decimal(38,2)")
    paid, sold = F.col("paid_total"), F.col("expected_total")
    gap = money(F.coalesce(paid, zero) - F.coalesce(sold, zero))
    return (
        ledger.withColumn("purchase_month", month_start(F.col("order_purchase_timestamp")))
        .withColumn("gap", gap)
        .withColumn("abs_gap", F.abs("gap"))
        .withColumn("gap_pct", pct(paid - sold, sold, 4))
        .withColumn("paid_to_sold_ratio", half_up(ratio(paid, sold), 4))
    )


#: Name and severity of each bucket, in the order in which they are tried.  A NULL severity is no exception;
#: paid orders without items are ``CLOSED_SEVERITY`` if the order is closed.
BUCKETS = (
    ("orphan_no_order", "high"), ("empty_order", "high"), ("missing_payment", "high"), ("missing_items", "high"), ("matched", None),
    ("rounding", "low"), ("voucher_related", "medium"), ("installment_interest", "low"), ("untracked_discount", "medium"), ("unexplained", "high"),
)
CLOSED_SEVERITY = "medium"
DISCOUNTS = ("0.05", "0.10")
NEAR = "0.02"


def bucket_conditions(tolerance: str = TOLERANCE) -> dict[str, str]:
    """The condition of every bucket but the last one, as SQL over a row of totals; it is what the rule table shows, too."""
    short = " OR ".join(f"abs(abs_gap - round(product_value * CAST({share} AS DECIMAL(3,2)), 2)) <= {NEAR}" for share in DISCOUNTS)
    return {
        "orphan_no_order": "NOT in_orders",
        "empty_order": "COALESCE(expected_total, paid_total) IS NULL",
        "missing_payment": "paid_total IS NULL",
        "missing_items": "expected_total IS NULL",
        "matched": f"abs_gap <= {tolerance}",
        "rounding": f"item_count > 1 AND abs_gap <= {tolerance} * item_count",
        "voucher_related": "has_voucher",
        "installment_interest": "gap > 0 AND only_credit_card AND max_installments > 1",
        "untracked_discount": f"gap < 0 AND ({short})",
    }


def bucket(tolerance: str = TOLERANCE) -> Column:
    """The first condition that holds names the bucket."""
    conditions = bucket_conditions(tolerance)
    name = F.lit(BUCKETS[-1][0])
    for own, _ in reversed(BUCKETS[:-1]):
        name = F.when(F.expr(conditions[own]), own).otherwise(name)
    return name


def bucket_severity() -> Column:
    name, severity = F.col("gap_category"), F.lit(None).cast("string")
    for own, value in BUCKETS:
        severity = F.when(name == own, F.lit(value).cast("string")).otherwise(severity)
    closed = (name == "missing_items") & F.col("order_status").isin(*CLOSED)
    return F.when(closed, CLOSED_SEVERITY).otherwise(severity)


RECONCILIATION = (
    "order_id", "in_orders", "order_status", "order_purchase_timestamp", "purchase_month", "customer_state",
    "item_count", "product_value", "freight_value", "expected_total", "payment_count", "paid_total", "payment_types",
    "main_payment_type", "max_installments", "has_voucher", "only_credit_card", "gap", "abs_gap", "gap_pct",
    "paid_to_sold_ratio", "has_dq_exception", "gap_category", "severity", "is_matched",
)


def judged_ledger(ledger: DataFrame, tolerance: str = TOLERANCE) -> DataFrame:
    """The ledger with gap, bucket, severity and match flag."""
    return (
        order_totals(ledger)
        .withColumn("gap_category", bucket(tolerance))
        .withColumn("severity", bucket_severity())
        .withColumn("is_matched", F.col("gap_category") == "matched")
    )


def ranked_gaps(reconciliation: DataFrame, freeze: Freeze) -> DataFrame:
    """Unmatched orders with their rank per month, per state and overall, and the running share of the gap.

    Overall rank and running share come from range partitions.  The dense ranks depend on distinct amounts
    only, so they are computed on (group, amount) pairs in money bands and looked up.
    """
    open_gaps = reconciliation.where(~F.col("is_matched")).select(
        "order_id", "purchase_month", "customer_state", "gap_category", "severity", "gap", "abs_gap",
        or_null_text(F.col("purchase_month")).alias("_month"),
        or_null_text(F.col("customer_state")).alias("_state"),
    )
    placed = ranged_positions(
        open_gaps,
        [F.col("abs_gap").desc(), F.col("order_id").asc()],
        freeze,
        "gap_ranges",
        "overall_rank",
        ("abs_gap", "_running", "_all_gaps"),
    )
    by_month = dense_rank_desc(open_gaps, ["_month"], "abs_gap", "gap_rank_in_month")
    by_state = dense_rank_desc(open_gaps, ["_state"], "abs_gap", "gap_rank_in_state")
    return (
        placed.join(by_month, ["_month", "abs_gap"])
        .join(by_state, ["_state", "abs_gap"])
        .select(
            "order_id",
            "purchase_month",
            "customer_state",
            "gap_category",
            "severity",
            "gap",
            "abs_gap",
            "gap_rank_in_month",
            "gap_rank_in_state",
            half_up(ratio(F.col("_running"), F.col("_all_gaps")), 6).alias("cumulative_gap_share"),
            "overall_rank",
        )
    )


def monthly_matching(reconciliation: DataFrame) -> DataFrame:
    """Match rate and gap per purchase month, and the change of unmatched orders against the month before."""
    unmatched = ~F.col("is_matched")
    months = (
        reconciliation.where(F.col("purchase_month").isNotNull())
        .groupBy("purchase_month")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if("is_matched").alias("matched_orders"),
            F.count_if(unmatched).alias("unmatched_orders"),
            F.sum(F.when(unmatched, F.col("abs_gap"))).alias("abs_gap"),
        )
    )
    # one row per month: the window sees the calendar, not the orders
    w = Window.orderBy(F.col("purchase_month").asc_nulls_last())
    return months.select(
        "purchase_month",
        "orders",
        "matched_orders",
        "unmatched_orders",
        money(F.col("abs_gap")).alias("abs_gap_brl"),
        pct(F.col("matched_orders"), F.col("orders"), 4).alias("match_rate_pct"),
        (F.col("unmatched_orders") - F.lag("unmatched_orders").over(w)).alias("unmatched_change_vs_prev_month"),
    )


def recon_exceptions(judged: DataFrame) -> DataFrame:
    """One exception per unmatched order, pointing at its first header row."""

    def total(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("none"))

    return judged.where(~F.col("is_matched")).select(
        F.lit("reconciliation").alias("table_name"),
        F.col("header_row_id").alias("record_id"),
        F.col("order_id").alias("record_key"),
        F.concat(F.lit("recon_"), "gap_category").alias("check_name"),
        sentence(
            "sold ", total(F.col("expected_total")), " vs paid ", total(F.col("paid_total")), " BRL, gap ", F.col("gap")
        ).alias("reason"),
        "severity",
        "order_id",
    )


#: The evidence query that shows a bucket's orders, and what is to be done about them.
BUCKET_NOTES = {
    "rounding": ("rounding_by_item_count", "accept"),
    "voucher_related": ("voucher_orders", "see what the voucher paid for"),
    "installment_interest": ("interest_by_installments", "split interest from the sale"),
    "untracked_discount": ("discount_share_of_price", "store the discount on the item"),
    "missing_items": ("missing_items_by_status", "look for a refund"),
    "missing_payment": (None, "look for the payment"),
    "orphan_no_order": (None, "look for the header"),
    "empty_order": (None, "ask where it comes from"),
    "unexplained": (None, "go through them from the largest gap down"),
}


def bucket_rules(spark: SparkSession, tolerance: str = TOLERANCE) -> DataFrame:
    """One row per bucket: name, severity, condition, evidence, action."""
    conditions = bucket_conditions(tolerance)
    rows = [(name, severity, conditions.get(name), *BUCKET_NOTES.get(name, (None, None))) for name, severity in BUCKETS]
    return spark.createDataFrame(rows, "gap_category string, severity string, rule string, evidence string, action string")


def reconciliation_summary(reconciliation: DataFrame) -> DataFrame:
    """Every bucket with its size, money and rule.  The rule table is ten constant rows, so it is broadcast."""
    buckets = reconciliation.groupBy("gap_category").agg(
        F.count(F.lit(1)).alias("orders"),
        *[money(F.sum(s)).alias(n) for s, n in (
            ("expected_total", "sold_brl"), ("paid_total", "paid_brl"), ("gap", "net_gap_brl"), ("abs_gap", "abs_gap_brl"),
        )],
    )
    every = Window.partitionBy()
    return buckets.join(F.broadcast(bucket_rules(reconciliation.sparkSession)), "gap_category", "left").select(
        "gap_category",
        "severity",
        "orders",
        pct(F.col("orders"), F.sum("orders").over(every), 4).alias("share_of_orders_pct"),
        "sold_brl",
        "paid_brl",
        "net_gap_brl",
        "abs_gap_brl",
        "rule",
        "evidence",
        "action",
    )


# ---- evidence behind the rules -------------------------------------------------------------------------


def _both_totals() -> Column:
    return F.col("expected_total").isNotNull() & F.col("paid_total").isNotNull()


def rounding_by_item_count(rec: DataFrame) -> DataFrame:
    small = (F.col("abs_gap") > F.lit("0.01").cast("decimal(12,2)")) & (F.col("abs_gap") <= F.lit("0.10").cast("decimal(12,2)"))
    return (
        rec.where(small & _both_totals())
        .groupBy("item_count")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money(F.min("abs_gap")).alias("min_abs_gap"),
            money(F.max("abs_gap")).alias("max_abs_gap"),
        )
    )


def interest_rate_card(rec: DataFrame) -> DataFrame:
    """Paid/sold ratios shared by at least three orders of one installment count."""
    return (
        rec.where(F.col("gap_category") == "installment_interest")
        .groupBy("max_installments", "paid_to_sold_ratio")
        .agg(F.count(F.lit(1)).alias("orders"))
        .where("orders >= 3")
    )


def interest_by_installments(rec: DataFrame) -> DataFrame:
    rows = rec.where(F.col("gap_category") == "installment_interest")
    stats = rows.groupBy("max_installments").agg(
        F.count(F.lit(1)).alias("orders"),
        half_up(F.min("gap_pct"), 2).alias("min_gap_pct"),
        half_up(F.max("gap_pct"), 2).alias("max_gap_pct"),
    )
    # four decimals: a whole percent holds at most 10,000 distinct values
    mid = exact_median(rows, ["max_installments"], "gap_pct", 1, "_mid")
    return stats.join(mid, "max_installments", "left").select(
        "max_installments", "orders", half_up(F.col("_mid"), 2).alias("median_gap_pct"), "min_gap_pct", "max_gap_pct"
    )


def discount_share_of_price(rec: DataFrame) -> DataFrame:
    return rec.where(
        (F.col("gap") < F.lit("-0.01").cast("decimal(12,2)"))
        & F.col("gap_category").isin("untracked_discount", "unexplained")
        & _both_totals()
    ).select(
        "order_id",
        "main_payment_type",
        "product_value",
        "gap",
        pct(-F.col("gap"), F.col("product_value"), 2).alias("discount_pct_of_price"),
        "gap_category",
    )


def missing_items_by_status(rec: DataFrame) -> DataFrame:
    return (
        rec.where(F.col("gap_category") == "missing_items")
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("paid_total")).alias("paid_brl"))
    )


def orders_with_sequence_gap(rec: DataFrame, dq: DataFrame) -> DataFrame:
    """Reconciliation rows of orders whose payment numbers have holes."""
    ids = (
        dq.where(F.col("check_name") == "payment_sequence_gap")
        .select(F.split_part("record_key", F.lit("|"), F.lit(1)).alias("order_id"))
        .distinct()
    )
    return rec.join(ids, "order_id", "left_semi")


def sequence_gap_orders_reconcile(rec: DataFrame, dq: DataFrame) -> DataFrame:
    return orders_with_sequence_gap(rec, dq).groupBy("gap_category").agg(F.count(F.lit(1)).alias("orders"))


def voucher_orders(rec: DataFrame) -> DataFrame:
    return rec.where(F.col("gap_category") == "voucher_related").select(
        "order_id", "payment_types", "expected_total", "paid_total", "gap", "gap_pct"
    )


EVIDENCE = {
    "rounding_by_item_count": rounding_by_item_count,
    "interest_rate_card": interest_rate_card,
    "interest_by_installments": interest_by_installments,
    "discount_share_of_price": discount_share_of_price,
    "missing_items_by_status": missing_items_by_status,
    "sequence_gap_orders_reconcile": sequence_gap_orders_reconcile,
    "voucher_orders": voucher_orders,
}


def order_audit(staged: Tables, reconciliation: DataFrame) -> DataFrame:
    """Every order id of any table appears once, and is matched or has one exception.

    Rows without an order id belong to no order; they are counted with their amount instead of disappearing.
    """
    ids = reduce(
        DataFrame.union, [staged[t].select("order_id") for t in ("orders", "order_items", "order_payments")]
    ).where(F.col("order_id").isNotNull())
    universe = ids.agg(F.count_distinct("order_id").alias("universe"))
    rows = reconciliation.agg(
        F.count(F.lit(1)).alias("reconciled"),
        F.count_distinct("order_id").alias("distinct_orders"),
        F.count_if("is_matched").alias("matched"),
        F.count_if(~F.col("is_matched")).alias("exceptions"),
    )
    return side_by_side(universe, rows).withColumn(
        "complete",
        (F.col("universe") == F.col("reconciled"))
        & (F.col("universe") == F.col("distinct_orders"))
        & (F.col("universe") == F.col("matched") + F.col("exceptions")),
    )


def rows_without_order(staged: Tables) -> DataFrame:
    amounts = {
        "orders": F.lit(0).cast("decimal(12,2)"),
        "order_items": F.col("price") + F.col("freight_value"),
        "order_payments": F.col("payment_value"),
    }
    parts = []
    for table, amount in amounts.items():
        missing = F.col("order_id").isNull()
        parts.append(
            staged[table]
            .agg(
                F.count_if(missing).alias("rows"),
                money(F.coalesce(F.sum(F.when(missing, amount)), F.lit(0))).alias("amount"),
            )
            .select(F.lit(table).alias("table_name"), "rows", "amount")
        )
    return reduce(DataFrame.unionByName, parts)
