"""Every registered query against its oracle, and the full run from CSV files."""

from __future__ import annotations

import csv
import json

import pytest

import __spark_entry__ as entry
from pyspark.sql import functions as F

from tallybook.plans import reconcile, star
from tallybook.plans.results import ORDERS, in_order
from tallybook.plans.workbench import Workbench
from tallybook.run import run_csv
from tests.compare import difference, oracle
from tests.shopdata import CONTRACTS, clean, item, order, payment

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "gap_category" and df.count() >= 8


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql:
        cur = con.execute(sql)
        assert difference(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_full_run_from_csv(spark, tmp_path):
    t = clean()
    t["orders"].append(order("x"))
    t["order_items"].append(item("x"))
    t["order_payments"].append(payment("x", "-1.00"))
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, spec in CONTRACTS.items():
        with open(raw / f"{name}.csv", "w", newline="", encoding="utf-8-sig") as f:
            w = csv.DictWriter(f, list(spec.columns))
            w.writeheader()
            w.writerows(t[name])
    out = tmp_path / "out"
    wb = run_csv(spark, str(raw), str(out))
    assert wb.counts.where("table_name = 'orders'").first().rows == 3
    text = "\n".join(p.read_text() for p in (out / "reports" / "metrics.json").glob("part-*"))
    m = json.loads(text)
    h = m["headline"]
    assert h["orders_matched"] + h["orders_unmatched"] == h["orders_total"] == 3
    assert sum(c["orders"] for c in m["categories"]) == h["orders_unmatched"] == 1
    assert sum(e["exceptions"] for e in m["exceptions_by_severity"]) == m["quality"]["exceptions"] + h["orders_unmatched"]
    assert m["checks_run"] == 81 and m["forecast"]["skipped"]
    for table in ("fact_orders", "fact_exceptions", "dim_date", "dim_customer_state"):
        assert spark.read.parquet(f"{out}/processed/{table}.parquet").count() > 0
    assert spark.read.parquet(f"{out}/processed/dim_customer_state.parquet").count() == 28
    assert (out / "reports" / "evidence" / "voucher_orders.csv").exists()


def test_own_contract_and_tolerance(spark, tmp_path):
    """A contract without reviews; whoever tolerates a gap of 5 cents has one unmatched order less."""
    t = clean()
    t["orders"].append(order("x"))
    t["order_items"].append(item("x"))
    t["order_payments"].append(payment("x", "110.05"))
    own = {n: s for n, s in CONTRACTS.items() if n != "order_reviews"}
    for name, spec in own.items():
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            w = csv.DictWriter(f, list(spec.columns))
            w.writeheader()
            w.writerows(t[name])
    for tolerance, unmatched in (("0.01", 1), ("0.10", 0)):
        wb = Workbench.from_csv(spark, str(tmp_path), contracts=own, tolerance=tolerance)
        assert "order_reviews" not in wb.raw and wb.dq.where("table_name = 'order_reviews'").count() == 0
        assert wb.reconciliation.where("not is_matched").count() == unmatched


def test_declared_orders(spark):
    rows = [("high", 1, "b"), ("low", 9, "a"), ("high", 3, "c"), ("medium", 5, "d"), ("high", 3, "a")]
    df = spark.createDataFrame(rows, "severity string, exceptions int, source string").selectExpr("*", "source table_name", "source check_name")
    got = [tuple(r)[:3] for r in in_order("exceptions_summary", df).collect()]
    assert got == [("high", 3, "a"), ("high", 3, "c"), ("high", 1, "b"), ("medium", 5, "d"), ("low", 9, "a")]
    gaps = spark.createDataFrame([("a", -5.0), ("b", 1.0), ("c", None), ("d", 5.0)], "order_id string, gap double")
    assert [r.order_id for r in in_order("voucher_orders", gaps).collect()] == ["a", "d", "b", "c"]
    assert set(reconcile.EVIDENCE) <= set(ORDERS)


def test_exceptions_without_order_stay_out_of_the_join(spark):
    kinds = "exception_id long, source string, table_name string, record_id long, record_key string, check_name string, reason string, severity string"
    keys = [("orders", "a"), ("orders", "<null>"), ("order_items", "b|1"), ("order_items", "<null>|2"), ("products", "a"), ("orders", None)]
    rows = [(i, "s", t, i, k, "c", "r", "high") for i, (t, k) in enumerate(keys)]
    orders = spark.createDataFrame([("a", 1, "SP"), ("b", 2, "RJ")], "order_id string, purchase_date_key int, state_code string")
    got = star.fact_exceptions(spark.createDataFrame(rows, kinds), orders).orderBy("exception_id").collect()
    assert [r.state_code for r in got] == ["SP", None, "RJ", None, None, None]
    assert [r.order_id for r in got] == ["a", "<null>", "b", "<null>", None, None]


def test_rows_without_key_are_spread(spark):
    rows = spark.range(400).selectExpr("id", "if(id % 2 = 0, null, id % 5) k")
    known = spark.range(4).selectExpr("id k", "id * 10 v")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = reconcile.left_join_spread(rows, known, "k", "id").selectExpr("*", "spark_partition_id() p").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 400 and all(r.v == (None if r.k in (None, 4) else r.k * 10) for r in got)
    assert len({r.p for r in got if r.k is None}) > 1


def test_exception_ids_stay_when_rows_are_added(spark):
    """Ids by content: the same in another run and beside other rows, also where digests collide and where rows repeat."""
    kinds = "source string, table_name string, record_id long, record_key string, check_name string, reason string, severity string"
    row = lambda k, reason="r": ("data_quality", "orders", k, f"k{k}", "c", reason, "low")
    first = [row(1), row(2), row(3), row(3), ("reconciliation", "reconciliation", None, None, "c", "r", "high")]
    more = [row(0), *first, row(9), row(9)]
    for digest in (F.md5, lambda t: F.lit("abc0"), lambda t: F.when(t.contains("k2"), "aa").otherwise("bb")):
        known = star.with_content_ids(spark.createDataFrame(first, kinds), digest=digest)
        held = sorted(map(tuple, known.collect()), key=str)
        assert len({r[0] for r in held}) == len(first)
        grown = star.merged_exceptions(spark.createDataFrame(held, known.schema), spark.createDataFrame(more, kinds), digest).collect()
        assert sorted(tuple(r)[1:] for r in grown if r.record_id is not None) == sorted(r for r in more if r[2] is not None)
        assert len({r.content_id for r in grown}) == len(more)
        ids = {r.content_id: tuple(r) for r in grown}
        assert all(ids[r[0]] == r for r in held)
