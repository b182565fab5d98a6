from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.plans import sampling
from tests.shopdata import bench, clean, item, order, payment, review


def shop(spark):
    t = clean()
    for i in range(30):
        oid = f"m{i}"
        t["orders"].append(order(oid, order_approved_at="2018-01-01 00:00:00" if i < 8 else "2018-01-05 11:00:00"))
        t["order_items"].append(item(oid))
        t["order_payments"].append(payment(oid))
        t["order_reviews"].append(review(f"rm{i}", oid))
    t["orders"].append(order("open"))
    t["order_payments"].append(payment("open", "5.00"))
    return bench(spark, t)


def test_sample_is_stratified_and_repeatable(spark):
    b = shop(spark)
    sizes = {"matched": 7, "missing_items": 3}
    first = b_rows = {r.order_id for r in sampling.bucket_sample(b.reconciliation, sizes).collect()}
    again = {r.order_id for r in sampling.bucket_sample(b.reconciliation.repartition(7), sizes).collect()}
    assert first == again and len(b_rows) == 8 and "open" in first
    assert sampling.check_sample(b.dq).count() == 3


def test_closure_keeps_related_rows_only(spark):
    b = shop(spark)
    picked = spark.createDataFrame([("m1",), ("o2",)], "order_id string")
    got = sampling.closure(b.raw, picked)
    assert {t: df.count() for t, df in got.items()} == {
        "orders": 2, "order_items": 2, "order_payments": 2, "order_reviews": 2, "customers": 2, "products": 1, "sellers": 1,
        "category_translation": 1,
    }
    assert "_row_id" not in got["orders"].columns
    assert got["customers"].agg(F.count_distinct("customer_id")).first()[0] == 2
