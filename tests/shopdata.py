"""A small hand-made shop: clean rows, and helpers to add or change some."""

from __future__ import annotations

from copy import deepcopy

from pyspark.sql import types as T

from tallybook.contracts import default_contracts
from tallybook.plans.star import federative_units
from tallybook.plans.workbench import Workbench

CONTRACTS = default_contracts()


def order(order_id: str, **kw) -> dict:
    row = {
        "order_id": order_id, "customer_id": "c1", "order_status": "delivered",
        "order_purchase_timestamp": "2018-01-05 10:00:00", "order_approved_at": "2018-01-05 11:00:00",
        "order_delivered_carrier_date": "2018-01-06 10:00:00", "order_delivered_customer_date": "2018-01-09 10:00:00",
        "order_estimated_delivery_date": "2018-01-20 00:00:00",
    }
    return {**row, **kw}


def item(order_id: str | None, n: str = "1", price: str = "100.00", freight: str = "10.00", **kw) -> dict:
    row = {
        "order_id": order_id, "order_item_id": n, "product_id": "p1", "seller_id": "s1",
        "shipping_limit_date": "2018-01-10 00:00:00", "price": price, "freight_value": freight,
    }
    return {**row, **kw}


def payment(order_id: str | None, value: str = "110.00", kind: str = "boleto", seq: str = "1", parts: str = "1", **kw) -> dict:
    row = {
        "order_id": order_id, "payment_sequential": seq, "payment_type": kind, "payment_installments": parts,
        "payment_value": value,
    }
    return {**row, **kw}


def review(review_id: str, order_id: str | None, score: str = "5", **kw) -> dict:
    row = {
        "review_id": review_id, "order_id": order_id, "review_score": score, "review_comment_title": None,
        "review_comment_message": "fine", "review_creation_date": "2018-01-10 00:00:00",
        "review_answer_timestamp": "2018-01-11 00:00:00",
    }
    return {**row, **kw}


def customer(customer_id: str, state: str = "SP", **kw) -> dict:
    row = {
        "customer_id": customer_id, "customer_unique_id": "u" + customer_id, "customer_zip_code_prefix": "01000",
        "customer_city": "sao paulo", "customer_state": state,
    }
    return {**row, **kw}


def product(product_id: str, category: str | None = "toys", **kw) -> dict:
    row = {
        "product_id": product_id, "product_category_name": category, "product_name_lenght": "10",
        "product_description_lenght": "20", "product_photos_qty": "1", "product_weight_g": "5", "product_length_cm": "1",
        "product_height_cm": "2", "product_width_cm": "3",
    }
    return {**row, **kw}


CLEAN = {
    "orders": [order("o1"), order("o2", customer_id="c2", order_purchase_timestamp="2018-02-03 09:00:00",
                                  order_approved_at="2018-02-03 10:00:00", order_delivered_carrier_date="2018-02-04 09:00:00",
                                  order_delivered_customer_date="2018-02-25 09:00:00")],
    "order_items": [item("o1"), item("o2")],
    "order_payments": [payment("o1"), payment("o2", kind="credit_card")],
    "order_reviews": [review("r1", "o1"), review("r2", "o2", "1")],
    "customers": [customer("c1"), customer("c2", "RJ")],
    "products": [product("p1")],
    "sellers": [{"seller_id": "s1", "seller_zip_code_prefix": "02000", "seller_city": "rio", "seller_state": "RJ"}],
    "category_translation": [{"product_category_name": "toys", "product_category_name_english": "toys_en"}],
}


def clean() -> dict[str, list[dict]]:
    return deepcopy(CLEAN)


def raw_frames(spark, tables: dict[str, list[dict]]) -> dict:
    out = {}
    for name, spec in CONTRACTS.items():
        cols = list(spec.columns)
        schema = T.StructType([T.StructField("_row_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in cols])
        out[name] = spark.createDataFrame([(i + 1, *[r[c] for c in cols]) for i, r in enumerate(tables[name])], schema)
    return out


def bench(spark, tables: dict[str, list[dict]]) -> Workbench:
    return Workbench(spark, raw_frames(spark, tables), CONTRACTS, federative_units(spark))
