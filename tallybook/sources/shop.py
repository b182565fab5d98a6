"""The analytics tables seen as a shop: raw text tables with planted, known defects.

The views follow FIXTURES.md part B.  Each planted defect is an integer rule on the order key (``k``), so the
same rows are hit at any size.  Everything is text except ``_row_id``, as if it came from CSV files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TableSpec, default_contracts, with_allowed
from ..operators.ordered import Freeze
from .readers import with_row_ids

# Number of nations in the analytics tables; their names are the state codes of the shop.
NATIONS = 25

CENTS = "decimal(12,2)"
RATE = "decimal(4,2)"


def shop_contracts() -> dict[str, TableSpec]:
    """The default contract with nation names in place of state codes."""
    states = tuple(f"NATION_{i}" for i in range(NATIONS))
    return with_allowed(default_contracts(), "customers", "customer_state", states)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _hours(n: Column) -> Column:
    return n * F.expr("interval '1' hour")


def _days(n: Column) -> Column:
    return n * F.expr("interval '1' day")


def _unknown(c: Column) -> Column:
    """An id that no table holds at any size."""
    return F.concat(F.lit("U"), _text(c))


def _price() -> Column:
    full = F.col("l_extendedprice").cast(CENTS)
    return F.round(full * (F.lit(1).cast(RATE) - F.col("l_discount").cast(RATE)), 2).cast(CENTS)


def _freight() -> Column:
    return F.round(F.col("l_extendedprice").cast(CENTS) * F.col("l_tax").cast(RATE), 2).cast(CENTS)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    bought = F.col("o_orderdate")
    status = (
        F.when(k % 503 == 0, "teleported")
        .when(k % 4 == 0, "canceled")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "processing")
    )
    customer = F.when(k % 1009 == 0, None).when(k % 1013 == 0, _unknown(F.col("o_custkey"))).otherwise(
        _text(F.col("o_custkey"))
    )
    carrier = bought + _days(k % 13 - 1)
    delivered = F.when(((status == "delivered") & (k % 97 != 0)) | (k % 89 == 0), carrier + _days(k % 17 - 1))
    copies = F.when(k % 2000 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _table(spark, folder, "orders")
        .select("*", F.explode(copies).alias("copy"))
        .select(
            (k * 2 + F.col("copy") + 1).alias("_row_id"),
            _text(k).alias("order_id"),
            customer.alias("customer_id"),
            status.alias("order_status"),
            _text(bought).alias("order_purchase_timestamp"),
            _text(bought + _hours(k % 7 - 1)).alias("order_approved_at"),
            _text(carrier).alias("order_delivered_carrier_date"),
            _text(delivered).alias("order_delivered_customer_date"),
            _text(bought + _days(F.lit(14))).alias("order_estimated_delivery_date"),
        )
    )


def order_lines(spark: SparkSession, folder: str, freeze: Freeze | None = None) -> DataFrame:
    """Order lines with row ids and their money in cents.  Numbered and worked out once like a landed CSV file if there is a ``freeze``."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    used = _table(spark, folder, "lineitem").select(*keys, _price().alias("line_price"), _freight().alias("line_freight"))
    lines = with_row_ids(used, freeze, "lineitem")
    if freeze:  # no later scan looks its file up again or makes decimals of doubles
        lines = freeze("lineitem_numbered", lines.withColumnRenamed("_row_id", "lineitem_row")).withColumnRenamed("lineitem_row", "_row_id")
    return lines


def order_items(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    k, line = F.col("l_orderkey"), F.col("l_linenumber")
    first = line == 1
    price = (
        F.when((k % 701 == 3) & first, "abc").when((k % 811 == 11) & first, "-5.00").otherwise(_text(F.col("line_price")))
    )
    freight = F.when((k % 821 == 13) & first, "-1.00").otherwise(_text(F.col("line_freight")))
    product = F.when(k % 607 == 5, _unknown(F.col("l_partkey"))).otherwise(_text(F.col("l_partkey")))
    if lines is None:
        lines = order_lines(spark, folder)
    return lines.select(
        "_row_id",
        _text(k).alias("order_id"),
        _text(line).alias("order_item_id"),
        product.alias("product_id"),
        _text(F.col("l_suppkey")).alias("seller_id"),
        _text(F.col("l_shipdate")).alias("shipping_limit_date"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def order_payments(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Payments derived from what each order sold; ``k % 20`` picks how the order was paid."""
    if lines is None:
        lines = _table(spark, folder, "lineitem").withColumns({"line_price": _price(), "line_freight": _freight()})
    price, freight = F.col("line_price"), F.col("line_freight")
    sold = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(price + freight).alias("sold"), F.sum(price).alias("goods"))
    k = F.col("o_orderkey")
    mode = k % 20
    base = F.coalesce("sold", F.lit("50.00").cast(CENTS)).cast(CENTS)
    goods = F.coalesce("goods", F.lit("0.00").cast(CENTS)).cast(CENTS)

    def dec(text: str, type_: str = CENTS) -> Column:
        return F.lit(text).cast(type_)

    value = (
        F.when(mode == 10, base + dec("0.01"))
        .when(mode == 11, base + dec("0.02"))
        .when(mode == 12, F.round(base * dec("1.0461", "decimal(5,4)"), 2))
        .when(mode == 13, base - dec("10.00"))
        .when(mode == 14, base - F.round(goods * dec("0.05", RATE), 2))
        .when(mode == 15, base - F.round(goods * dec("0.10", RATE), 2))
        .when(mode == 17, base + dec("37.00"))
        .otherwise(base)
        .cast(CENTS)
    )
    kind = F.when(mode.isin(10, 11, 17), "boleto").when(mode == 14, "debit_card").otherwise("credit_card")

    def payment(slot: int, order_id: Column, seq: Column, type_: Column, installments: Column, amount: Column) -> Column:
        return F.struct(
            (k * 4 + slot).alias("_row_id"),
            order_id.alias("order_id"),
            _text(seq).alias("payment_sequential"),
            type_.alias("payment_type"),
            _text(installments).alias("payment_installments"),
            _text(amount).alias("payment_value"),
        )

    main = payment(
        1,
        _text(k),
        F.when(mode == 18, 2).otherwise(1),
        F.when(k % 911 == 19, "bitcoin").otherwise(kind),
        F.when(mode == 12, 3).otherwise(1),
        F.when(k % 907 == 17, dec("-1.00")).otherwise(value),
    )
    voucher = payment(
        2,
        _text(k),
        F.lit(2),
        F.lit("voucher"),
        F.when(mode == 13, 1).otherwise(0),
        F.when(mode == 13, dec("12.00")).otherwise(dec("0.00")),
    )
    stray = payment(3, _unknown(k), F.lit(1), F.lit("boleto"), F.lit(1), dec("99.90"))
    rows = F.array(
        F.when(mode != 16, main),
        F.when(mode.isin(13, 19), voucher),
        F.when(k % 500 == 0, stray),
    )
    return (
        _table(spark, folder, "orders")
        .select("o_orderkey")
        .join(sold, "o_orderkey", "left")
        .select(F.explode(rows).alias("payment"))
        .where(F.col("payment").isNotNull())
        .select("payment.*")
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    made = F.substring(_text(F.col("ts")), 1, 19).cast("timestamp_ntz")
    return _table(spark, folder, "events").select(
        (e + 1).alias("_row_id"),
        _text(F.when(e % 1000 == 1, e - 1).otherwise(e)).alias("review_id"),
        F.when(e % 500 == 0, _unknown(e)).otherwise(_text(e)).alias("order_id"),
        _text(F.when(e % 613 == 0, 9).otherwise(e % 5 + 1)).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.col("event_type").alias("review_comment_message"),
        _text(made).alias("review_creation_date"),
        _text(made + _hours(e % 9 - 1)).alias("review_answer_timestamp"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = _table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        _table(spark, folder, "customer")
        .join(nations, "c_nationkey", "left")
        .select(
            (F.col("c_custkey") + 1).alias("_row_id"),
            _text(F.col("c_custkey")).alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            _text(F.col("c_nationkey")).alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    nations = _table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return (
        _table(spark, folder, "supplier")
        .join(nations, "s_nationkey", "left")
        .select(
            (F.col("s_suppkey") + 1).alias("_row_id"),
            _text(F.col("s_suppkey")).alias("seller_id"),
            _text(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    p, size = F.col("p_partkey"), F.col("p_size")
    return _table(spark, folder, "part").select(
        (p + 1).alias("_row_id"),
        _text(p).alias("product_id"),
        F.when(p % 101 != 0, F.lower("p_type")).alias("product_category_name"),
        _text(F.length("p_name")).alias("product_name_lenght"),
        _text(F.length("p_brand")).alias("product_description_lenght"),
        _text(size % 10).alias("product_photos_qty"),
        _text(size * 100).alias("product_weight_g"),
        _text(size).alias("product_length_cm"),
        _text(size + 1).alias("product_height_cm"),
        _text(size + 2).alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    """A translation for every part type except PROMO; ``_row_id`` is the smallest part key of the type."""
    return (
        _table(spark, folder, "part")
        .where(F.col("p_type") != "PROMO")
        .groupBy("p_type")
        .agg((F.min("p_partkey") + 1).alias("_row_id"))
        .select(
            "_row_id",
            F.lower("p_type").alias("product_category_name"),
            F.concat(F.lit("en_"), F.lower("p_type")).alias("product_category_name_english"),
        )
    )


def states(spark: SparkSession, folder: str) -> DataFrame:
    """State code, name and region from the nation and region tables."""
    regions = _table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        _table(spark, folder, "nation")
        .join(regions, "n_regionkey", "left")
        .select(
            F.col("n_name").alias("state_code"),
            F.initcap(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))).alias("state_name"),
            F.col("r_name").alias("region"),
        )
    )


def raw_tables(spark: SparkSession, folder: str, freeze: Freeze | None = None) -> dict[str, DataFrame]:
    """All eight raw tables.  Payments are the one view that costs a shuffle, so ``freeze`` writes it once."""
    lines = order_lines(spark, folder, freeze)
    payments = order_payments(spark, folder, lines)
    return {
        "orders": orders(spark, folder),
        "order_items": order_items(spark, folder, lines),
        "order_payments": freeze("raw_order_payments", payments) if freeze else payments,
        "order_reviews": order_reviews(spark, folder),
        "customers": customers(spark, folder),
        "products": products(spark, folder),
        "sellers": sellers(spark, folder),
        "category_translation": category_translation(spark, folder),
    }
