"""Contract and business checks, exceptions, row status, usable rows, audits."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import SEVERITIES, TEXT, TableSpec
from ..functions.casts import to_contract_type
from ..functions.numeric import pct
from ..functions.text import record_key, sentence
from ..operators.checks import (
    CARRIED,
    Reference,
    RowRule,
    UniqueKey,
    duplicate_keys,
    flag_rows,
    orphans,
    sequence_gaps,
)
from ..operators.ordered import Freeze

Tables = Mapping[str, DataFrame]
Contracts = Mapping[str, TableSpec]

QUARANTINE = ("high", "medium")


def typed(raw: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Staged rows: same rows, contract types, NULL where a value does not fit."""
    return raw.select(
        "_row_id", *[to_contract_type(F.col(c), s.type, strict).alias(c) for c, s in spec.columns.items()]
    )


def _beside(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw text columns with the typed value beside each as ``t_<column>``."""
    return raw.select(
        "_row_id",
        *spec.columns,
        *[to_contract_type(F.col(c), s.type).alias(f"t_{c}") for c, s in spec.columns.items()],
    )


def contract_rules(spec: TableSpec) -> list[RowRule]:
    """Required, type and value-list rules of one table."""
    key = record_key([F.col(c) for c in spec.primary_key])
    rules = []
    for name, col in spec.columns.items():
        raw, value = F.col(name), F.col(f"t_{name}")
        if col.required:
            rules.append(
                RowRule("required_null", spec.severity["required_null"], raw.isNull(),
                        F.lit(f"{name} is required but empty"), key)
            )
        if col.type != TEXT:
            rules.append(
                RowRule("type_mismatch", spec.severity["type_mismatch"], raw.isNotNull() & value.isNull(),
                        sentence(f"{name} = '", raw, f"' is not a valid {col.type}"), key)
            )
        if col.allowed:
            rules.append(
                RowRule("allowed_values", col.severity or spec.severity["allowed_values"],
                        value.isNotNull() & ~value.isin(list(col.allowed)),
                        sentence(f"{name} = '", raw, "' is not an allowed value"), key)
            )
    return rules


def _t(name: str) -> Column:
    return F.col(f"t_{name}")


def _order_rules() -> list[RowRule]:
    key = record_key([_t("order_id")])
    bought, approved = _t("order_purchase_timestamp"), _t("order_approved_at")
    carrier, delivered = _t("order_delivered_carrier_date"), _t("order_delivered_customer_date")
    status = _t("order_status")

    def before(check: str, severity: str, what: str, a: Column, then: str, b: Column) -> RowRule:
        return RowRule(check, severity, a < b, sentence(what, a, then, b), key)

    return [
        before("approved_before_purchase", "high", "approved ", approved, " is before purchase ", bought),
        before("carrier_before_purchase", "high", "handed to carrier ", carrier, " before purchase ", bought),
        before("delivered_before_purchase", "high", "delivered ", delivered, " before purchase ", bought),
        before("delivered_before_carrier", "medium", "delivered ", delivered, " before carrier pickup ", carrier),
        before("carrier_before_approval", "low", "handed to carrier ", carrier, " before approval ", approved),
        RowRule("delivered_without_date", "medium", (status == "delivered") & delivered.isNull(),
                F.lit("status is delivered but order_delivered_customer_date is empty"), key),
        RowRule("delivery_date_on_undelivered_order", "medium", (status != "delivered") & delivered.isNotNull(),
                sentence("status is ", status, " but a customer delivery date exists"), key),
    ]


def _item_rules() -> list[RowRule]:
    key = record_key([_t("order_id"), _t("order_item_id")])
    price, freight = _t("price"), _t("freight_value")
    return [
        RowRule("non_positive_price", "high", price <= 0, sentence("price = ", price, " (must be > 0)"), key),
        RowRule("negative_freight", "high", freight < 0, sentence("freight_value = ", freight, " (must be >= 0)"), key),
    ]


def _payment_rules() -> list[RowRule]:
    key = record_key([_t("order_id"), _t("payment_sequential")])
    value, kind, parts = _t("payment_value"), _t("payment_type"), _t("payment_installments")
    return [
        RowRule("negative_payment", "high", value < 0, sentence("payment_value = ", value), key),
        RowRule("zero_value_payment", "low", value == 0, sentence(kind, " payment with value 0.00"), key),
        RowRule("invalid_installments", "medium", parts < 1,
                sentence(kind, " payment with ", parts, " installments (must be >= 1)"), key),
    ]


def _review_rules() -> list[RowRule]:
    made, answered = _t("review_creation_date"), _t("review_answer_timestamp")
    return [
        RowRule("review_answered_before_created", "medium", answered < made,
                sentence("answered ", answered, " before created ", made), record_key([_t("review_id")])),
    ]


BUSINESS_RULES = {
    "orders": _order_rules,
    "order_items": _item_rules,
    "order_payments": _payment_rules,
    "order_reviews": _review_rules,
}


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unique_keys(raw: Tables, contracts: Contracts) -> list[UniqueKey]:
    return [UniqueKey(raw[t], t, spec.primary_key, spec.key_severity) for t, spec in contracts.items()]


def all_references(raw: Tables, contracts: Contracts) -> list[Reference]:
    """Foreign keys of the contract, and the business rule that a review belongs to a known order."""
    out = []
    for table, spec in contracts.items():
        for fk in spec.foreign_keys:
            out.append(
                Reference(
                    raw[table], table, spec.primary_key, fk.column, raw[fk.ref_table], fk.ref_column,
                    "orphan_foreign_key", fk.severity, f"{fk.column} = '", f"' not found in {fk.ref_table}.{fk.ref_column}",
                )
            )
    if "order_reviews" in contracts and "orders" in contracts:
        reviews = contracts["order_reviews"].primary_key
        out.append(
            Reference(
                raw["order_reviews"], "order_reviews", reviews, "order_id", raw["orders"], "order_id",
                "review_unknown_order", "high", "order_id ", " not found in orders",
            )
        )
    return out


def dq_exceptions(raw: Tables, contracts: Contracts, checks: Collection[str] | None = None, freeze: Freeze | None = None) -> DataFrame:
    """All exceptions of the input tables (or only of the named ``checks``), each with the order it touches."""
    return _stack(exception_parts(raw, contracts, checks, freeze))


def exception_parts(raw: Tables, contracts: Contracts, checks: Collection[str] | None = None, freeze: Freeze | None = None) -> list[DataFrame]:
    """The exceptions in parts that share no work, so each can be written by a query of its own.

    One scan per table for all row rules; one pipeline each for all unique keys, all references and the payment
    sequence.  ``freeze`` writes the few keys and values that the second passes are about.
    """
    name = "dq" if checks is None else "_".join(sorted(checks))

    def wanted(check: str) -> bool:
        return checks is None or check in checks

    parts: list[DataFrame] = []
    for table, spec in contracts.items():
        rules = contract_rules(spec) + (BUSINESS_RULES[table]() if table in BUSINESS_RULES else [])
        rules = [r for r in rules if wanted(r.check)]
        if rules:
            order_id = F.col("order_id") if "order_id" in spec.columns else F.lit(None)
            parts.append(flag_rows(_beside(raw[table], spec), table, rules, order_id))
    if wanted("duplicate_key"):
        parts.append(duplicate_keys(unique_keys(raw, contracts), freeze, f"{name}_repeated_keys"))
    references = [r for r in all_references(raw, contracts) if wanted(r.check)]
    if references:
        parts.append(orphans(references, freeze, f"{name}_orphan_values"))
    if wanted("payment_sequence_gap"):
        parts.append(sequence_gaps(typed(raw["order_payments"], contracts["order_payments"])))
    return [p.select(*CARRIED) for p in parts]


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Put the columns of several one-row results into one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def flagged_records(dq: DataFrame) -> DataFrame:
    """One row per record with an exception: is it quarantined (any high or medium) or only warned about."""
    return dq.groupBy("table_name", "record_id").agg(
        F.bool_or(F.col("severity").isin(*QUARANTINE)).alias("quarantined")
    )


def row_status(raw: Tables, dq: DataFrame) -> DataFrame:
    """Status of every input record: clean, warning or quarantined."""
    flagged = flagged_records(dq)
    status = F.when(F.col("quarantined"), "quarantined").when(F.col("quarantined").isNotNull(), "warning").otherwise("clean")
    rows = _stack([df.select(F.lit(t).alias("table_name"), F.col("_row_id").alias("record_id")) for t, df in raw.items()])
    return rows.join(flagged, ["table_name", "record_id"], "left").select(
        "table_name", "record_id", status.alias("row_status")
    )


def clean_rows(staged: DataFrame, table: str, dq: DataFrame) -> DataFrame:
    """Usable rows of a staged table: everything except quarantined records."""
    bad = (
        dq.where((F.col("table_name") == table) & F.col("severity").isin(*QUARANTINE))
        .select(F.col("record_id").alias("_row_id"))
        .distinct()
    )
    return staged.join(bad, "_row_id", "left_anti")


def row_status_counts(counts: DataFrame, dq: DataFrame) -> DataFrame:
    """Rows per table and status, from row counts and flagged records only (no row-level join)."""
    flagged = flagged_records(dq).groupBy("table_name").agg(
        F.count_if("quarantined").alias("quarantined"), F.count_if(~F.col("quarantined")).alias("warning")
    )
    zero = F.lit(0).cast("long")
    q, w = F.coalesce("quarantined", zero), F.coalesce("warning", zero)
    return counts.join(flagged, "table_name", "left").select(
        "table_name",
        F.col("rows").alias("rows_in"),
        (F.col("rows") - q - w).alias("clean"),
        w.alias("warning"),
        q.alias("quarantined"),
    )


def exceptions_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("exceptions"))


def exceptions_summary(all_exceptions: DataFrame) -> DataFrame:
    return all_exceptions.groupBy("source", "table_name", "check_name", "severity").agg(
        F.count(F.lit(1)).alias("exceptions"), F.count_distinct("record_key").alias("distinct_records")
    )


def quality_totals(counts: DataFrame, dq: DataFrame) -> DataFrame:
    """One row: exceptions by severity, distinct flagged records, quarantined records, share of clean rows."""
    by_severity = dq.agg(
        F.count(F.lit(1)).alias("exceptions"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES],
    )
    records = flagged_records(dq).agg(
        F.count(F.lit(1)).alias("records_with_exceptions"), F.count_if("quarantined").alias("records_quarantined")
    )
    rows = counts.agg(F.sum("rows").alias("rows_in"))
    return side_by_side(by_severity, records, rows).withColumn(
        "pct_rows_clean", pct(F.col("rows_in") - F.col("records_with_exceptions"), F.col("rows_in"), 2)
    )


def table_audit(raw: Tables, staged: Tables, counts: DataFrame, dq: DataFrame) -> DataFrame:
    """Nothing dropped: per table, input = usable + quarantined = unflagged + flagged."""
    status = row_status(raw, dq).groupBy("table_name").agg(
        F.count_if(F.col("row_status") == "clean").alias("unflagged"),
        F.count_if(F.col("row_status") == "quarantined").alias("quarantined"),
    )
    flagged = dq.groupBy("table_name").agg(F.count_distinct("record_id").alias("flagged"))
    # what ``clean_rows`` keeps of every table, in one anti join
    bad = dq.where(F.col("severity").isin(*QUARANTINE)).select("table_name", F.col("record_id").alias("_row_id")).distinct()
    kept = _stack([df.select(F.lit(t).alias("table_name"), "_row_id") for t, df in staged.items()])
    usable = kept.join(bad, ["table_name", "_row_id"], "left_anti").groupBy("table_name").agg(F.count(F.lit(1)).alias("usable"))
    return (
        counts.join(status, "table_name", "left")
        .join(usable, "table_name", "left")
        .join(flagged, "table_name", "left")
        .select(
            "table_name",
            F.col("rows").alias("rows_in"),
            F.coalesce("usable", F.lit(0).cast("long")).alias("usable"),
            F.coalesce("quarantined", F.lit(0).cast("long")).alias("quarantined"),
            F.coalesce("unflagged", F.lit(0).cast("long")).alias("unflagged"),
            F.coalesce("flagged", F.lit(0).cast("long")).alias("flagged"),
        )
        .withColumn(
            "complete",
            (F.col("rows_in") == F.col("usable") + F.col("quarantined"))
            & (F.col("rows_in") == F.col("unflagged") + F.col("flagged")),
        )
    )


def incomplete_exceptions(all_exceptions: DataFrame) -> DataFrame:
    """Count of exception rows with a missing field or an unknown severity; must be zero."""
    bad = ~F.col("severity").isin(*SEVERITIES) | F.col("severity").isNull()
    for c in ("table_name", "record_key", "check_name", "reason"):
        bad = bad | F.col(c).isNull()
    return all_exceptions.agg(F.count_if(bad).alias("incomplete"), F.count(F.lit(1)).alias("exceptions"))
