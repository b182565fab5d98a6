"""Every check fires on the record that was broken, and only there."""

from __future__ import annotations

import pytest

from tallybook.plans import quality, reconcile
from tests.shopdata import bench, clean, customer, item, order, payment, product, raw_frames, review, CONTRACTS


def test_clean_shop_has_no_exceptions(spark):
    b = bench(spark, clean())
    assert b.dq.count() == 0
    assert {r.row_status for r in b.row_status.collect()} == {"clean"}


@pytest.fixture(scope="module")
def broken(spark):
    """One defect per row; expected exceptions as (table, record key, check, severity)."""
    t = clean()
    want = set()

    def expect(table, key, check, severity):
        want.add((table, key, check, severity))

    def orders(oid, check, severity, **kw):
        t["orders"].append(order(oid, **kw))
        expect("orders", oid, check, severity)

    orders("d01", "required_null", "high", customer_id=None)
    orders("d02", "type_mismatch", "high", order_approved_at="yesterday")
    orders("d03", "allowed_values", "medium", order_status="teleported", order_delivered_customer_date=None)
    orders("d04", "orphan_foreign_key", "high", customer_id="nobody")
    orders("d05", "approved_before_purchase", "high", order_approved_at="2018-01-04 00:00:00")
    orders("d06", "carrier_before_purchase", "high", order_delivered_carrier_date="2018-01-01 00:00:00", order_approved_at=None)
    orders("d07", "delivered_before_purchase", "high", order_delivered_customer_date="2018-01-01 00:00:00",
           order_delivered_carrier_date=None)
    orders("d08", "delivered_before_carrier", "medium", order_delivered_carrier_date="2018-01-10 10:00:00")
    orders("d09", "carrier_before_approval", "low", order_approved_at="2018-01-07 00:00:00")
    orders("d10", "delivered_without_date", "medium", order_delivered_customer_date=None)
    orders("d11", "delivery_date_on_undelivered_order", "medium", order_status="canceled")
    orders("d12", "duplicate_key", "high")
    t["orders"].append(order("d12"))
    orders("d13", "required_null", "high", order_estimated_delivery_date=None)

    def items(n, check, severity, **kw):
        t["order_items"].append(item("o1", n, **kw))
        expect("order_items", f"o1|{n}", check, severity)

    items("2", "type_mismatch", "high", price="abc")
    items("3", "non_positive_price", "high", price="0.00")
    items("4", "negative_freight", "high", freight="-1.00")
    items("5", "orphan_foreign_key", "medium", product_id="nothing")
    items("6", "orphan_foreign_key", "medium", seller_id="nobody")
    t["order_items"].append(item("ghost"))
    expect("order_items", "ghost|1", "orphan_foreign_key", "high")

    def pays(oid, check, severity, **kw):
        t["orders"].append(order(oid))
        t["order_payments"].append(payment(oid, **kw))
        expect("order_payments", f"{oid}|{kw.get('seq', '1')}", check, severity)

    pays("p01", "negative_payment", "high", value="-5.00")
    pays("p02", "zero_value_payment", "low", value="0")
    pays("p03", "invalid_installments", "medium", parts="0")
    pays("p04", "payment_sequence_gap", "low", seq="2")
    pays("p05", "allowed_values", "medium", kind="bitcoin")
    t["order_payments"].append(payment("ghost2"))
    expect("order_payments", "ghost2|1", "orphan_foreign_key", "high")

    t["order_reviews"] += [
        review("v1", "o1", "9"),
        review("v2", "o1", review_answer_timestamp="2018-01-09 00:00:00"),
        review("v3", "ghost"),
        review("r1", "o2"),
    ]
    expect("order_reviews", "v1", "allowed_values", "medium")
    expect("order_reviews", "v2", "review_answered_before_created", "medium")
    expect("order_reviews", "v3", "review_unknown_order", "high")
    expect("order_reviews", "r1", "duplicate_key", "medium")
    t["customers"].append(customer("c9", "XX"))
    expect("customers", "c9", "allowed_values", "medium")
    t["products"] += [product("p9", "untranslated"), product("p8", None), product("p7", product_weight_g="heavy")]
    expect("products", "p9", "orphan_foreign_key", "medium")
    expect("products", "p7", "type_mismatch", "high")
    return bench(spark, t), want


def test_each_defect_is_found_once(broken):
    b, want = broken
    got = [(r.table_name, r.record_key, r.check_name, r.severity) for r in b.dq.collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


def test_a_named_check_runs_alone(broken):
    b, want = broken
    got = quality.dq_exceptions(b.raw, b.contracts, ["negative_freight"]).collect()
    assert [(r.record_key, r.check_name) for r in got] == [("o1|4", "negative_freight")]
    assert got[0].reason == "freight_value = -1.00 (must be >= 0)"


def test_nothing_is_dropped(broken):
    b, _ = broken
    audit = quality.table_audit(b.raw, b.staged, b.counts, b.dq).collect()
    assert len(audit) == 8 and all(r.complete for r in audit)
    assert reconcile.order_audit(b.staged, b.reconciliation).first().complete
    assert quality.incomplete_exceptions(b.all_exceptions).first().incomplete == 0


def test_low_severity_rows_stay_usable(broken):
    b, _ = broken
    ids = {r.order_id for r in b.clean("order_payments").collect()}
    assert {"p02", "p04"} <= ids and not {"p01", "p03", "p05"} & ids


def test_exception_ids_are_dense(broken):
    b, want = broken
    ids = sorted(r.exception_id for r in b.dq_numbered.collect())
    assert ids == list(range(1, len(want) + 1))
    everything = b.exceptions_numbered.collect()
    assert sorted(r.exception_id for r in everything) == list(range(1, len(everything) + 1))
    keys = [(r.source, r.table_name, r.record_id is None, r.record_id or 0, r.check_name) for r in sorted(everything, key=lambda r: r.exception_id)]
    assert keys == sorted(keys)


def test_null_keys(spark):
    t = clean()
    t["order_items"].append(item(None, "1"))
    t["order_payments"] += [payment(None, seq="1"), payment(None, seq="1")]
    got = quality.dq_exceptions(raw_frames(spark, t), CONTRACTS).collect()
    assert sorted((r.table_name, r.record_key, r.check_name) for r in got) == [
        ("order_items", "<null>|1", "required_null"),
        ("order_payments", "<null>|1", "required_null"),
        ("order_payments", "<null>|1", "required_null"),
    ]


@pytest.mark.parametrize("change", ["duplicate", "orphan", "negative", "bad_type"])
def test_completeness_survives_corruption(spark, change):
    t = clean()
    if change == "duplicate":
        t["order_items"].append(item("o1"))
    elif change == "orphan":
        t["order_payments"].append(payment("0" * 32, "10.00"))
    elif change == "negative":
        t["order_items"][0]["price"] = "-3"
    else:
        t["order_items"][0]["freight_value"] = "n/a"
    b = bench(spark, t)
    assert b.dq.count() == 1
    assert all(r.complete for r in quality.table_audit(b.raw, b.staged, b.counts, b.dq).collect())
    assert reconcile.order_audit(b.staged, b.reconciliation).first().complete
