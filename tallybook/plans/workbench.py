"""Connects the plans: raw tables in, every derived table out.

A table that several plans start from is a stage (written once); everything else stays a lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TableSpec, default_contracts
from ..sources import shop
from ..sources.readers import load_csv_tables, row_counts, with_row_ids
from ..sources.stage import Stages
from . import forecast, quality, reconcile, sampling, star


class Workbench:
    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        contracts: Mapping[str, TableSpec],
        states: DataFrame,
        stages: Stages | None = None,
        tolerance: str = reconcile.TOLERANCE,
    ):
        self.spark = spark
        self.raw = dict(raw)
        self.contracts = contracts
        self.states = states
        self.stages = stages or Stages(spark)
        self.tolerance = tolerance
        self.folder: str | None = None
        self._checked: dict[str, DataFrame] = {}

    @classmethod
    def from_analytics(cls, spark: SparkSession, folder: str) -> Workbench:
        """Shop-shaped views over the analytics tables."""
        stages = Stages(spark)
        raw = shop.raw_tables(spark, folder, stages.freeze)
        bench = cls(spark, raw, shop.shop_contracts(), shop.states(spark, folder), stages)
        bench.folder = folder
        return bench

    @classmethod
    def from_csv(
        cls,
        spark: SparkSession,
        folder: str,
        files: Mapping[str, str] | None = None,
        multi_line: bool = True,
        contracts: Mapping[str, TableSpec] | None = None,
        tolerance: str = reconcile.TOLERANCE,
    ) -> Workbench:
        """The CSV tables of a contract, by default the built-in one of eight tables."""
        stages, contracts = Stages(spark), contracts or default_contracts()
        raw = load_csv_tables(spark, folder, contracts, stages.freeze, files, multi_line)
        return cls(spark, raw, contracts, star.federative_units(spark), stages, tolerance)

    def close(self) -> None:
        """Remove the stage tables; the workbench and what was made from it are done with."""
        self.stages.remove()

    @cached_property
    def lineitem_ids(self) -> DataFrame:
        """The analytics table of order lines with row ids."""
        return with_row_ids(self.spark.read.parquet(f"{self.folder}/lineitem.parquet"), self.stages.freeze, "lineitem")

    @cached_property
    def counts(self) -> DataFrame:
        return self.stages.freeze("raw_counts", row_counts(self.raw))

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        return {t: quality.typed(self.raw[t], spec) for t, spec in self.contracts.items()}

    @cached_property
    def dq(self) -> DataFrame:
        return self.stages.freeze_parts("dq_exceptions", quality.exception_parts(self.raw, self.contracts, freeze=self.stages.freeze))

    def checked(self, check: str) -> DataFrame:
        """Exceptions of one check alone."""
        if check not in self._checked:
            self._checked[check] = quality.dq_exceptions(self.raw, self.contracts, [check], self.stages.freeze)
        return self._checked[check]

    @cached_property
    def dq_numbered(self) -> DataFrame:
        return star.numbered_exceptions(self.dq.drop("order_id"), self.stages.freeze, "dq_ranges")

    @cached_property
    def row_status(self) -> DataFrame:
        return quality.row_status(self.raw, self.dq)

    def clean(self, table: str) -> DataFrame:
        return quality.clean_rows(self.staged[table], table, self.dq)

    @cached_property
    def judged(self) -> DataFrame:
        ledger = reconcile.order_ledger(self.staged, self.dq)
        return self.stages.freeze("judged_ledger", reconcile.judged_ledger(ledger, self.tolerance))

    @cached_property
    def reconciliation(self) -> DataFrame:
        return self.judged.select(*reconcile.RECONCILIATION)

    @cached_property
    def ranked(self) -> DataFrame:
        return self.stages.freeze("ranked_gaps", reconcile.ranked_gaps(self.reconciliation, self.stages.freeze))

    @cached_property
    def recon_exceptions(self) -> DataFrame:
        return reconcile.recon_exceptions(self.judged)

    @cached_property
    def all_exceptions(self) -> DataFrame:
        return star.all_exceptions(self.dq, self.recon_exceptions)

    @cached_property
    def exceptions_numbered(self) -> DataFrame:
        return star.numbered_exceptions(self.all_exceptions, self.stages.freeze, "exception_ranges")

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.stages.freeze("dim_date", star.dim_date(self.staged["orders"]).coalesce(1))

    @cached_property
    def dim_customer_state(self) -> DataFrame:
        return self.stages.freeze("dim_customer_state", star.dim_customer_state(self.states))

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return self.stages.freeze("dim_payment_type", star.dim_payment_type(self.staged["order_payments"]))

    @cached_property
    def dim_product_category(self) -> DataFrame:
        dim = star.dim_product_category(self.staged["products"], self.staged["category_translation"])
        return self.stages.freeze("dim_product_category", dim)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return star.fact_orders(self.judged)

    @cached_property
    def fact_reconciliation(self) -> DataFrame:
        return self.stages.freeze("fact_reconciliation", star.fact_reconciliation(self.judged, self.ranked))

    @cached_property
    def fact_exceptions(self) -> DataFrame:
        return self.stages.freeze("fact_exceptions", star.fact_exceptions(self.exceptions_numbered, self.fact_orders))

    @property
    def star(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in star.STAR_TABLES}

    @cached_property
    def orders_per_month(self) -> DataFrame:
        """One series of all orders, its complete months marked."""
        months = forecast.monthly_orders(self.fact_orders, self.dim_date)
        return self.stages.freeze("orders_per_month", forecast.complete_window(months))

    @cached_property
    def series_per_month(self) -> DataFrame:
        """One series per state and product category, complete months marked."""
        name = F.concat_ws("/", "state_code", "category_key")
        months = forecast.monthly_orders(self.fact_orders, self.dim_date, name)
        return self.stages.freeze("series_per_month", forecast.complete_window(months))

    @cached_property
    def held_orders(self) -> DataFrame:
        """Held-out months of the one series beside what each of the four candidates predicted."""
        return self.stages.freeze("held_orders", forecast.holdout_rows(forecast.usable(self.orders_per_month), forecast.ALL))

    @cached_property
    def held_series(self) -> DataFrame:
        return self.stages.freeze("held_series", forecast.holdout_rows(forecast.usable(self.series_per_month), forecast.ALL))

    @cached_property
    def picked_orders(self) -> DataFrame:
        """Orders of the repeatable sample, ranked once for all tables that are cut down to them."""
        return self.stages.freeze("picked_orders", sampling.picked_orders(self.reconciliation, self.dq))
