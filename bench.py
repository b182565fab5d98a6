"""Time the stages and the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stage tables are built first and timed on their own (``stage_*``); queries then start from them, as they do in a
run of the library.  Every query result is computed in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybook.catalog import QUERIES  # noqa: E402
from tallybook.plans.workbench import Workbench  # noqa: E402
from tallybook.session import local_session  # noqa: E402

STAGES = (
    "counts", "dq", "judged", "ranked", "dim_date", "dim_customer_state", "dim_payment_type", "dim_product_category",
    "fact_reconciliation", "fact_exceptions", "orders_per_month", "series_per_month",
)
HEADLINE = (
    "scan_row_ids", "staged_order_items", "dq_duplicate_key", "dq_type_mismatch", "dq_orphan_foreign_key",
    "dq_payment_sequence_gap", "dq_row_status", "dq_clean_order_items", "dq_exceptions_summary", "dq_totals",
    "recon_monthly", "recon_summary", "recon_interest_by_installments", "recon_sequence_gap_orders",
    "star_fact_orders", "star_unresolved_keys", "kpi_headline", "kpi_gap_by_category", "kpi_pareto",
    "kpi_exceptions_by_check", "kpi_row_status", "kpi_monthly", "kpi_top_states", "kpi_top_categories", "kpi_delivery",
    "kpi_reviews_by_match", "kpi_payment_mix", "kpi_interest_rate_card_share", "kpi_sequence_gaps",
    "kpi_unmatched_detail", "kpi_largest_gaps", "kpi_measures_by_month", "kpi_drill_down", "fc_run", "fc_series_scores",
    "sample_closure_counts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="tallybook-bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        t = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - t, 3)

    bench = {}
    timed("stage_raw", lambda: bench.update(wb=Workbench.from_analytics(spark, folder)))
    wb = bench["wb"]
    for stage in STAGES:
        timed(f"stage_{stage}", lambda s=stage: getattr(wb, s))
    for name in HEADLINE:
        timed(name, lambda n=name: QUERIES[n].build(wb).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total time of stages and headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
