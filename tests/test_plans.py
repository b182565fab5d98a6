"""Shape of the physical plans: what is read, shuffled, broadcast and crossed."""

from __future__ import annotations

import re

import pytest

from tallybook.catalog import QUERIES
from tallybook.plans import quality, reconcile, sampling
from tallybook.plans.workbench import Workbench

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wb(spark):
    return Workbench.from_analytics(spark, FOLDER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_reads_each_table_once_and_shuffles_once_per_order(wb):
    text = plan(reconcile.order_ledger(wb.staged, wb.dq))
    assert len(re.findall(r"FileScan parquet.*lineitem", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", text)) == 1
    assert "partial_min_by" in text and "partial_sum" in text


def test_row_rules_run_in_one_scan_and_one_codegen_stage(wb):
    text = plan(quality.dq_exceptions(wb.raw, wb.contracts, ["non_positive_price", "negative_freight"]))
    assert len(re.findall(r"FileScan parquet.*lineitem", text)) == 1
    assert "Exchange hashpartitioning" not in text and "SinglePartition" not in text
    assert re.search(r"\*\(\d+\) Generate explode", text)


def test_duplicates_and_orphans_combine_before_the_shuffle(wb):
    text = plan(quality.dq_exceptions(wb.raw, wb.contracts, ["duplicate_key"]))
    assert "partial_count" in text
    text = plan(quality.dq_exceptions(wb.raw, wb.contracts, ["orphan_foreign_key"]))
    assert "LeftAnti" in text and "LeftSemi" in text


def test_columns_are_pruned_in_the_scan(wb):
    text = plan(wb.staged["order_items"].select("order_id", "price"))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "l_suppkey" not in schema and "l_shipdate" not in schema and "l_tax" not in schema


def test_first_rows_and_samples_are_cut_in_the_map_tasks(wb):
    assert "WindowGroupLimit" in plan(reconcile.first_rows(wb.staged["orders"], "order_id"))
    assert "WindowGroupLimit" in plan(sampling.bucket_sample(wb.reconciliation))


def test_filters_reach_the_scan(wb):
    text = plan(reconcile.voucher_orders(wb.reconciliation))
    assert re.search(r"PushedFilters: \[.*EqualTo\(gap_category,voucher_related\)", text)


def test_top_k_needs_no_global_sort(wb):
    assert "TakeOrderedAndProject" in plan(QUERIES["kpi_largest_gaps"].build(wb))


def test_no_query_crosses_tables(wb):
    for name, q in QUERIES.items():
        text = plan(q.build(wb))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        assert "Cross" not in text, name


def test_hot_groups_are_spread_even_after_a_join_on_the_group(spark, wb):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(quality.dq_exceptions(wb.raw, wb.contracts, ["duplicate_key"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text
    assert re.search(r"Exchange hashpartitioning\(code#\d+, key_0#\d+, key_1#\d+, _band#\d+L", text)


def test_money_of_order_lines_is_worked_out_once(wb):
    """What reads order lines finds decimals and makes none of doubles."""
    text = plan(wb.staged["order_items"].select("order_id", "price", "freight_value"))
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "line_price:decimal(12,2)" in schema and "double" not in schema
