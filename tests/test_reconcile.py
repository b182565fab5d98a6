from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.plans import kpis, reconcile
from tests.shopdata import bench, clean, customer, item, order, payment, product

GOODS, FREIGHT = Decimal("87.40"), Decimal("6.15")
CENT = Decimal("0.01")


def sold(n: int) -> list[tuple[str, str]]:
    """``n`` items of one price."""
    return [(str(GOODS), str(FREIGHT))] * n


def paid(n: int, gap, kind: str = "boleto", parts: int = 1) -> list[tuple[str, str, str]]:
    """One payment of what ``n`` items cost and ``gap`` on top."""
    return [(kind, str(parts), str(n * (GOODS + FREIGHT) + Decimal(gap)))]


def cases() -> list[tuple]:
    """(order, items, payments, header changes, bucket, severity), each made from the rule whose edge it lies on."""
    out = []

    def add(name, items, payments, bucket, severity, header=()):
        out.append((name, items, payments, None if header is None else dict(header), bucket, severity))

    # up to a cent is a match, on either side; what follows is one cent for each of several items
    for sign in (-1, 0, 1):
        add(f"tolerance{sign:+d}", sold(1), paid(1, sign * CENT), "matched", None)
    for n in (2, 5):
        add(f"rounding_all_{n}_cents", sold(n), paid(n, n * CENT), "rounding", "low")
        add(f"rounding_past_{n}_cents", sold(n), paid(n, (n + 1) * CENT), "unexplained", "high")
    add("one_item_does_not_round", sold(1), paid(1, 2 * CENT), "unexplained", "high")
    # a voucher explains any gap that rounding does not
    for gap in ("-7.77", "0.90"):
        add(f"voucher_{gap}", sold(1), [("credit_card", "1", "60.00"), ("voucher", "1", str(GOODS + FREIGHT - 60 + Decimal(gap)))], "voucher_related", "medium")
    # interest: more than sold, by card alone, in parts
    for parts, kind, gap, bucket in ((2, "credit_card", "2.71", True), (11, "credit_card", "19.36", True), (1, "credit_card", "2.71", False), (2, "boleto", "2.71", False)):
        add(f"interest_{parts}_{kind}", sold(1), paid(1, gap, kind, parts), *(("installment_interest", "low") if bucket else ("unexplained", "high")))
    add("interest_with_cash", sold(1), [("credit_card", "4", "70.00"), ("boleto", "1", str(GOODS + FREIGHT - 68))], "unexplained", "high")
    # discounts: a twentieth or a tenth of the goods, two cents either way
    for share in (Decimal("0.05"), Decimal("0.10")):
        for off, bucket in ((0, True), (2, True), (-2, True), (3, False), (-3, False)):
            short = -(GOODS * share).quantize(CENT) + off * CENT
            add(f"discount_{share}_{off}", sold(1), paid(1, short, "debit_card"), *(("untracked_discount", "medium") if bucket else ("unexplained", "high")))
    add("discount_of_seven_percent", sold(1), paid(1, "-6.12", "debit_card"), "unexplained", "high")
    # one side is missing
    add("sold_only", sold(2), [], "missing_payment", "high")
    for status, severity in (("canceled", "medium"), ("unavailable", "medium"), ("invoiced", "high"), ("delivered", "high")):
        add(f"paid_only_{status}", [], paid(1, 0), "missing_items", severity, {"order_status": status})
    add("neither", [], [], "empty_order", "high")
    add("orphan", [("14.00", "2.50")], [("boleto", "1", "16.50")], "orphan_no_order", "high", None)
    return out


CASES = cases()


@pytest.fixture(scope="module")
def shop(spark):
    t = clean()
    for oid, items, payments, header, *_ in CASES:
        if header is not None:
            t["orders"].append(order(oid, **header))
        t["order_items"] += [item(oid, str(n), p, f) for n, (p, f) in enumerate(items, 1)]
        t["order_payments"] += [payment(oid, v, k, str(n), parts) for n, (k, parts, v) in enumerate(payments, 1)]
    # an unpaid order whose only item has an unreadable price sells nothing measurable
    t["orders"].append(order("bad_price"))
    t["order_items"].append(item("bad_price", price="abc"))
    t["order_payments"].append(payment("bad_price", "10.00"))
    # the customer twice must not double the order, nor the product
    t["customers"].append(customer("c1", "BA"))
    t["products"].append(product("p1", "books"))
    # the order twice: the first copy counts
    t["orders"].append(order("tolerance+0", order_status="shipped", customer_id="c2"))
    # rows without an order id
    t["order_items"].append(item(None, "9", "5.00", "1.00"))
    t["order_payments"] += [payment(None, "7.00"), payment(None, "8.00", seq="2")]
    return bench(spark, t)


@pytest.fixture(scope="module")
def rows(shop):
    return {r.order_id: r for r in shop.reconciliation.collect()}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_bucket(rows, case):
    assert (rows[case[0]].gap_category, rows[case[0]].severity) == case[4:]


def test_one_row_per_order_id(shop, rows):
    assert shop.reconciliation.count() == len(rows) == len(CASES) + 3


def test_first_header_and_first_customer_count(rows):
    assert rows["tolerance+0"].order_status == "delivered" and rows["tolerance+0"].customer_state == "SP"
    assert rows["tolerance+0"].paid_total == GOODS + FREIGHT


def test_unreadable_price_lowers_sold(rows):
    r = rows["bad_price"]
    assert r.item_count == 1 and r.expected_total is None and r.gap_category == "missing_items" and r.has_dq_exception


def test_main_payment_is_the_largest_row(rows):
    assert rows["voucher_-7.77"].main_payment_type == "credit_card"
    assert rows["interest_with_cash"].main_payment_type == "credit_card"
    assert rows["voucher_-7.77"].payment_types == "credit_card+voucher"
    assert rows["sold_only"].payment_types is None and rows["sold_only"].main_payment_type is None


def test_rows_without_order_are_reported(shop):
    got = {r.table_name: (r.rows, r.amount) for r in reconcile.rows_without_order(shop.staged).collect()}
    assert got == {"orders": (0, Decimal("0.00")), "order_items": (1, Decimal("6.00")), "order_payments": (2, Decimal("15.00"))}


def test_one_exception_per_unmatched_order(shop, rows):
    exc = shop.recon_exceptions.collect()
    assert {r.record_key for r in exc} == {k for k, r in rows.items() if not r.is_matched} and len(exc) == len({r.record_key for r in exc})
    orphan = next(r for r in exc if r.record_key == "orphan")
    assert orphan.record_id is None and orphan.check_name == "recon_orphan_no_order"
    assert orphan.reason == "sold 16.50 vs paid 16.50 BRL, gap 0.00"


def test_ranks_are_those_of_counting(shop, rows):
    """Every rank recomputed from the reconciled orders by counting what lies before it."""
    unmatched = [r for r in rows.values() if not r.is_matched]
    total = sum(r.abs_gap for r in unmatched)
    got = {r.order_id: r for r in shop.ranked.collect()}
    assert got.keys() == {r.order_id for r in unmatched}
    for r in unmatched:
        ahead = [o for o in unmatched if (-o.abs_gap, o.order_id) <= (-r.abs_gap, r.order_id)]
        assert got[r.order_id].overall_rank == len(ahead)
        assert got[r.order_id].cumulative_gap_share == pytest.approx(float(sum(o.abs_gap for o in ahead) / total), abs=1e-6)
        for own, rank in (("purchase_month", "gap_rank_in_month"), ("customer_state", "gap_rank_in_state")):
            larger = {o.abs_gap for o in unmatched if getattr(o, own) == getattr(r, own) and o.abs_gap > r.abs_gap}
            assert getattr(got[r.order_id], rank) == len(larger) + 1


def test_every_fact_key_resolves(shop):
    from tallybook.plans.star import unresolved_keys

    assert all(r.unresolved == 0 for r in unresolved_keys(shop.star).collect())


def test_orphan_with_equal_totals_counts_as_explained_but_is_shown(shop):
    d = kpis.derived_ratios(shop.fact_reconciliation).first()
    assert d.orphans_in_both_systems == 1


def test_pareto_at_exactly_80_percent(spark):
    df = spark.createDataFrame([(0.8, False), (0.9, False), (1.0, False)], "cumulative_gap_share double, is_matched boolean")
    r = kpis.pareto(df).first()
    assert (r.orders_for_80pct_of_gap, r.orders_for_80pct_exact) == (2, 1)
    r = kpis.pareto(df.where("is_matched")).first()
    assert (r.orders_for_80pct_of_gap, r.orders_for_80pct_exact, r.unmatched_orders) == (1, 0, 0)


def test_other_tolerance(shop):
    wide = reconcile.judged_ledger(shop.judged, "0.05").select("order_id", "gap_category")
    got = {r.order_id: r.gap_category for r in wide.collect()}
    assert got["one_item_does_not_round"] == "matched" and got["rounding_past_5_cents"] != "matched"


def test_category_is_that_of_the_first_product_row(shop):
    row = shop.fact_orders.where("order_id = 'tolerance+0'").first()
    assert row.category_key == "toys" and row.state_code == "SP"
    assert shop.fact_reconciliation.where("order_id = 'orphan'").first().category_key == "unknown"
    assert {r.category_key for r in shop.dim_product_category.collect()} == {"toys", "books", "unknown"}


def test_late_and_on_time(shop):
    d = kpis.delivery(shop.fact_orders).first()
    assert d.late_orders == 1 and d.on_time_orders + d.late_orders == d.delivered_orders


def test_dim_date_reaches_last_purchase(spark):
    t = clean()
    t["orders"].append(order("late_buyer", order_purchase_timestamp="2019-06-01 00:00:00", order_approved_at=None,
                             order_delivered_carrier_date=None, order_delivered_customer_date=None, order_status="created",
                             order_estimated_delivery_date="2018-01-20 00:00:00"))
    b = bench(spark, t)
    assert str(b.dim_date.agg(F.max("date")).first()[0]) == "2019-06-01"
    assert kpis.monthly(b.fact_reconciliation, b.fact_orders, b.fact_exceptions, b.dim_date).where("month = '2019-06'").count() == 1


def ledger(shop, **kw) -> list[tuple]:
    rows = reconcile.judged_ledger(reconcile.order_ledger(shop.staged, shop.dq, **kw))
    return sorted((tuple(r.asDict().items()) for r in rows.collect()), key=repr)


def test_large_orders_are_reduced_apart_with_the_same_result(shop):
    assert ledger(shop, hot_rows=3) == ledger(shop)


def test_any_number_of_payment_types(shop, monkeypatch):
    want = ledger(shop)
    monkeypatch.setattr(reconcile, "TYPE_BITS", 1)  # more types than bits: sets of texts again
    assert ledger(shop) == want


def test_payment_types_of_an_order_in_the_order_of_their_bytes(spark):
    kinds = ["voucher", "\u00e9clair", "Pix", "pix", "", "zz", "\U0001f4b3"]
    t = clean()
    t["orders"].append(order("kinds"))
    t["order_payments"] += [payment("kinds", "1.00", k, str(n)) for n, k in enumerate([*kinds, None, "pix"], 1)]
    row = bench(spark, t).judged.where("order_id = 'kinds'").first()
    assert row.payment_types == "+".join(sorted(kinds, key=str.encode)) and row.main_payment_type == "voucher"


def test_ledger_gathers_no_sets_and_sorts_rows_of_an_order_once(shop):
    text = reconcile.order_ledger(shop.staged, shop.dq)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in text
    assert text.index("partial_min_by") < text.index("Exchange hashpartitioning(order_id")  # the tree is printed from its root
