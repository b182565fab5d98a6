"""Star schema: four dimensions, three facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import NULL_TEXT, date_key, month_start
from ..operators.ordered import Freeze, ranged_positions
from ..operators.checks import EXCEPTION
from .reconcile import first_rows

STAR_TABLES = (
    "fact_orders", "fact_reconciliation", "fact_exceptions",
    "dim_date", "dim_customer_state", "dim_payment_type", "dim_product_category",
)

# The 27 federative units with name and region, and the texts of the known payment types.
FEDERATIVE_UNITS = (
    ("AC", "Acre", "North"),
    ("AL", "Alagoas", "Northeast"),
    ("AM", "Amazonas", "North"),
    ("AP", "Amapá", "North"),
    ("BA", "Bahia", "Northeast"),
    ("CE", "Ceará", "Northeast"),
    ("DF", "Distrito Federal", "Center-West"),
    ("ES", "Espírito Santo", "Southeast"),
    ("GO", "Goiás", "Center-West"),
    ("MA", "Maranhão", "Northeast"),
    ("MG", "Minas Gerais", "Southeast"),
    ("MS", "Mato Grosso do Sul", "Center-West"),
    ("MT", "Mato Grosso", "Center-West"),
    ("PA", "Pará", "North"),
    ("PB", "Paraíba", "Northeast"),
    ("PE", "Pernambuco", "Northeast"),
    ("PI", "Piauí", "Northeast"),
    ("PR", "Paraná", "South"),
    ("RJ", "Rio de Janeiro", "Southeast"),
    ("RN", "Rio Grande do Norte", "Northeast"),
    ("RO", "Rondônia", "North"),
    ("RR", "Roraima", "North"),
    ("RS", "Rio Grande do Sul", "South"),
    ("SC", "Santa Catarina", "South"),
    ("SE", "Sergipe", "Northeast"),
    ("SP", "São Paulo", "Southeast"),
    ("TO", "Tocantins", "North"),
)
PAYMENT_TEXTS = {
    "credit_card": "Credit card (can be split into installments)",
    "debit_card": "Debit card",
    "boleto": "Boleto bancário (bank slip, paid in cash or online banking)",
    "voucher": "Voucher / gift card",
    "none": "No payment recorded",
}
CARDS = ("credit_card", "debit_card")
# Tables whose record key starts with an order id.
ORDER_KEYED = ("orders", "order_items", "order_payments", "reconciliation")


def federative_units(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FEDERATIVE_UNITS), "state_code string, state_name string, region string")


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day, from the first purchase to the last date a fact may use (purchases included)."""
    days = orders.agg(
        F.min("order_purchase_timestamp").cast("date").alias("first"),
        F.greatest(
            F.max("order_estimated_delivery_date").cast("date"),
            F.max("order_delivered_customer_date").cast("date"),
            F.max("order_purchase_timestamp").cast("date"),
        ).alias("last"),
    ).where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("d"))
    d = F.col("d")
    weekday = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        month_start(d).alias("month_start"),
        F.weekofyear(d).alias("iso_week"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def dim_customer_state(states: DataFrame) -> DataFrame:
    """The given states plus the unknown member."""
    text = F.lit("Unknown")
    unknown = states.sparkSession.range(1).select(
        F.lit("UNKNOWN").alias("state_code"), text.alias("state_name"), text.alias("region")
    )
    return states.select("state_code", "state_name", "region").unionByName(unknown).distinct()


def dim_payment_type(payments: DataFrame) -> DataFrame:
    """Every payment type seen, plus 'none'."""
    seen = payments.where(F.col("payment_type").isNotNull()).select("payment_type")
    kinds = seen.union(payments.sparkSession.range(1).select(F.lit("none"))).distinct()
    kind = F.col("payment_type")
    text = F.concat(F.lit("Not in the contract: "), kind)
    for name, words in PAYMENT_TEXTS.items():
        text = F.when(kind == name, words).otherwise(text)
    return kinds.select("payment_type", text.alias("description"), kind.isin(*CARDS).alias("is_card"))


def dim_product_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Every category seen, plus 'unknown'; a category without a translation keeps its own name."""
    unknown = F.lit("unknown")
    seen = products.select(F.coalesce("product_category_name", unknown).alias("category_key"))
    keys = seen.union(products.sparkSession.range(1).select(unknown)).distinct()
    english = first_rows(translation, "product_category_name").select(
        F.col("product_category_name").alias("category_key"), F.col("product_category_name_english").alias("english")
    )
    key = F.col("category_key")
    return keys.join(english, "category_key", "left").select(
        "category_key",
        F.nullif(key, unknown).alias("category_name_pt"),
        F.coalesce("english", key).alias("category_name_en"),
        (F.col("english").isNotNull() | (key == unknown)).alias("has_translation"),
    )


def fact_orders(judged: DataFrame) -> DataFrame:
    """One row per order of the orders table; a projection of the judged ledger."""
    bought, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    return judged.where("in_orders").select(
        "order_id",
        "customer_id",
        F.coalesce("customer_state", F.lit("UNKNOWN")).alias("state_code"),
        date_key(bought).alias("purchase_date_key"),
        date_key(delivered).alias("delivered_date_key"),
        date_key(promised).alias("estimated_date_key"),
        "order_status",
        F.coalesce("main_payment_type", F.lit("none")).alias("payment_type"),
        "category_key",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        "product_value",
        "freight_value",
        F.col("expected_total").alias("sold_value"),
        F.col("paid_total").alias("paid_value"),
        delivered.isNotNull().alias("is_delivered"),
        F.when(delivered.isNotNull(), delivered.cast("date") <= promised.cast("date")).alias("is_on_time"),
        F.datediff(delivered.cast("date"), bought.cast("date")).cast("long").alias("delivery_days"),
        "review_score",
        "review_count",
        "is_matched",
        "gap_category",
        "has_dq_exception",
    )


RANKS = ("gap_rank_in_month", "gap_rank_in_state", "cumulative_gap_share")


def fact_reconciliation(judged: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row per order id of any system.

    Only unmatched orders carry ranks, so only they meet the rank table; matched orders are never shuffled.
    """
    rows = judged.select(
        "order_id",
        F.coalesce("customer_state", F.lit("UNKNOWN")).alias("state_code"),
        date_key(F.col("order_purchase_timestamp")).alias("purchase_date_key"),
        F.coalesce("main_payment_type", F.lit("none")).alias("payment_type"),
        F.when(F.col("in_orders"), F.col("category_key")).otherwise("unknown").alias("category_key"),
        "in_orders",
        "order_status",
        "item_count",
        "payment_count",
        "payment_types",
        "max_installments",
        "has_voucher",
        "product_value",
        "freight_value",
        "expected_total",
        "paid_total",
        "gap",
        "abs_gap",
        "gap_pct",
        "paid_to_sold_ratio",
        "is_matched",
        "gap_category",
        "severity",
        "has_dq_exception",
    )
    unmatched = rows.where(~F.col("is_matched")).join(ranked.select("order_id", *RANKS), "order_id")
    return rows.where("is_matched").unionByName(unmatched, allowMissingColumns=True)


def numbered_exceptions(exceptions: DataFrame, freeze: Freeze, label: str) -> DataFrame:
    """Dense ``exception_id`` in a total order; the reason breaks ties between columns of one row."""
    keys = [k for k in ("source", "table_name", "record_id", "check_name", "reason", "record_key") if k in exceptions.columns]
    return ranged_positions(exceptions, [F.col(k).asc_nulls_last() for k in keys], freeze, label, "exception_id")


_CONTENT = ("source", "table_name", "record_id", "record_key", "check_name", "reason", "severity")


def with_content_ids(exceptions: DataFrame, known: DataFrame | None = None, digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """Exceptions with ``content_id``, which depends on what an exception says and not on what else was found.

    The id is a digest of 128 bits.  Contents that share a digest are told apart by a number behind it, and so are rows that say the same.
    ``known`` is the table of an earlier run: what it holds keeps its id, and numbers go on where it stopped.
    """
    own = [c for c in _CONTENT if c in exceptions.columns]
    text = F.to_json(F.struct(*own), {"ignoreNullFields": "false"})
    rows = exceptions.withColumn("_text", text).withColumn("_digest", digest(F.col("_text")))
    # one row per content, however often it comes; equal digests are next to none
    contents = rows.groupBy("_digest", "_text").agg(F.count(F.lit(1)).alias("_copies"))
    if known is not None:
        before = known.withColumn("_text", text).select("_text", F.regexp_extract("content_id", "^([0-9a-f]+)", 1).alias("_digest"),
                                                        F.coalesce(F.regexp_extract("content_id", "-([0-9]+)", 1).try_cast("int"), F.lit(0)).alias("_old"))
        before = before.groupBy("_digest", "_text").agg(F.min("_old").alias("_old"))
        used = before.groupBy("_digest").agg((F.max("_old") + 1).alias("_next"))
        contents = contents.join(before, ["_digest", "_text"], "left").join(used, "_digest", "left")
    else:
        contents = contents.withColumn("_old", F.lit(None).cast("int")).withColumn("_next", F.lit(None).cast("int"))
    fresh = Window.partitionBy("_digest", F.col("_old").isNull()).orderBy("_text")
    number = F.coalesce("_old", F.coalesce("_next", F.lit(0)) + F.row_number().over(fresh) - 1)
    name = F.concat("_digest", F.when(number > 0, F.concat(F.lit("-"), number.cast("string"))).otherwise(""))
    # copies of one content are numbered in the row that stands for them
    copies = F.sequence(F.lit(1), F.col("_copies").cast("int"))
    named = contents.withColumn("_name", name).select("_text", "_name", F.explode(copies).alias("_copy"))
    content = F.from_json("_text", exceptions.select(*own).schema)
    label = F.concat("_name", F.when(F.col("_copy") > 1, F.concat(F.lit("#"), F.col("_copy").cast("string"))).otherwise(""))
    return named.select(label.alias("content_id"), content.alias("_content")).select("content_id", "_content.*")


def merged_exceptions(known: DataFrame, found: DataFrame, digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """The table of an earlier run with what ``found`` adds to it; ids of both stay as they are."""
    new = with_content_ids(found, known, digest)
    return known.unionByName(new.join(known.select("content_id"), "content_id", "left_anti").select(*known.columns))


def all_exceptions(dq: DataFrame, recon: DataFrame) -> DataFrame:
    """Data quality and reconciliation exceptions in one table, with their source."""
    return dq.select(F.lit("data_quality").alias("source"), *EXCEPTION).unionByName(
        recon.select(F.lit("reconciliation").alias("source"), *EXCEPTION)
    )


def fact_exceptions(numbered: DataFrame, orders: DataFrame) -> DataFrame:
    """Every exception with the order, purchase day and state it belongs to.

    Rows that belong to no order (no key, or its part reads ``<null>``) may be a large share; they stay out of the join.
    """
    order_id = F.when(
        F.col("table_name").isin(*ORDER_KEYED), F.split_part("record_key", F.lit("|"), F.lit(1))
    )
    where = orders.select("order_id", "purchase_date_key", "state_code")
    rows = numbered.withColumn("order_id", order_id)
    keyed = F.coalesce(F.col("order_id") != NULL_TEXT, F.lit(False))
    known = rows.where(keyed).join(where, "order_id", "left")
    return known.unionByName(rows.where(~keyed), allowMissingColumns=True).select(
        "exception_id", "source", "table_name", "record_id", "record_key", "order_id", "check_name", "reason",
        "severity", "purchase_date_key", "state_code",
    )


def unresolved_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose key has no dimension row, per fact and key; must be zero everywhere."""
    dims = (
        ("state_code", "dim_customer_state", "state_code"),
        ("payment_type", "dim_payment_type", "payment_type"),
        ("category_key", "dim_product_category", "category_key"),
        ("purchase_date_key", "dim_date", "date_key"),
    )
    out = None
    for fact in ("fact_orders", "fact_reconciliation"):
        for key, dim, dim_key in dims:
            used = tables[fact].where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            known = tables[dim].select(F.col(dim_key).alias(key))
            one = used.join(known, key, "left_anti").agg(
                F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("unresolved")
            ).select(F.lit(fact).alias("fact"), F.lit(key).alias("key"), "unresolved")
            out = one if out is None else out.unionByName(one)
    return out


def star_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name in STAR_TABLES:
        one = tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
