"""One full run: load, check, reconcile, build the star, export everything.

    python -m tallybook.run <folder with the CSV tables> <output folder> [--single-line] [--contract FILE] [--tolerance 0.01]

``--single-line`` is for files without line breaks in fields: Spark then splits large files.  ``--contract`` names a contract document
(JSON, or YAML where a parser for it is installed) in place of the built-in one of eight tables.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

from .contracts import TableSpec, contracts_from
from .plans import forecast, metrics, quality, reconcile
from .plans.results import described, in_order
from .plans.workbench import Workbench
from .sources.sinks import export_tables, write_csv

ALL_MODELS = forecast.ALL


def export_all(wb: Workbench, out: str) -> dict:
    """Star tables (Parquet and CSV), evidence and summaries (CSV), forecast table (CSV), metrics (JSON)."""
    export_tables(wb.star, f"{out}/processed")
    write_csv(forecast.forecast_table(wb.orders_per_month, ALL_MODELS, wb.held_orders), f"{out}/processed/forecast_monthly.csv")
    for name, query in reconcile.EVIDENCE.items():
        args = (wb.reconciliation, wb.dq) if name == "sequence_gap_orders_reconcile" else (wb.reconciliation,)
        write_csv(in_order(name, query(*args)), f"{out}/reports/evidence/{name}.csv")
    summaries = {
        "reconciliation_summary": reconcile.reconciliation_summary(wb.reconciliation),
        "exceptions_summary": quality.exceptions_summary(wb.all_exceptions),
    }
    for name, df in summaries.items():
        write_csv(in_order(name, df), f"{out}/reports/{name}.csv")
    write_csv(described(wb.star), f"{out}/reports/columns.csv")
    return metrics.write_document(wb, f"{out}/reports/metrics.json", ALL_MODELS)


def run_csv(
    spark: SparkSession,
    raw: str,
    out: str,
    files: Mapping[str, str] | None = None,
    multi_line: bool = True,
    contracts: Mapping[str, TableSpec] | None = None,
    tolerance: str = reconcile.TOLERANCE,
) -> Workbench:
    """``contracts`` (see ``contracts_from``) and ``tolerance`` replace the built-in ones."""
    wb = Workbench.from_csv(spark, raw, files, multi_line, contracts, tolerance)
    export_all(wb, out)
    return wb


def read_contract(path: str) -> dict[str, TableSpec]:
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return contracts_from(json.loads(text))
    import yaml

    return contracts_from(yaml.safe_load(text))


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallybook.run")
    parser.add_argument("raw")
    parser.add_argument("out")
    parser.add_argument("--single-line", action="store_true")
    parser.add_argument("--contract", type=read_contract)
    parser.add_argument("--tolerance", default=reconcile.TOLERANCE)
    return parser.parse_args(argv)


if __name__ == "__main__":
    given = arguments()
    session = SparkSession.builder.appName("tallybook").getOrCreate()
    run_csv(session, given.raw, given.out, multi_line=not given.single_line, contracts=given.contract, tolerance=given.tolerance).close()
