"""What each input table must look like, as data.  The driver only ever holds this metadata."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Default severities, status values, payment types and the 27 state codes of the contract.
DEFAULT_SEVERITY = {
    "duplicate_key": "high",
    "required_null": "high",
    "type_mismatch": "high",
    "allowed_values": "medium",
    "orphan_foreign_key": "high",
}
SEVERITIES = ("high", "medium", "low")
ORDER_STATUSES = (
    "created", "approved", "invoiced", "processing", "shipped", "delivered", "canceled", "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
STATE_CODES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)

TEXT = "VARCHAR"
INT = "INTEGER"
TIME = "TIMESTAMP"
CENTS = "DECIMAL(12,2)"


@dataclass(frozen=True)
class ColumnSpec:
    type: str = TEXT
    required: bool = False
    allowed: tuple = ()
    severity: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref_table: str
    ref_column: str
    severity: str = DEFAULT_SEVERITY["orphan_foreign_key"]


@dataclass(frozen=True)
class TableSpec:
    primary_key: tuple[str, ...]
    columns: dict[str, ColumnSpec]
    foreign_keys: tuple[ForeignKey, ...] = ()
    key_severity: str = DEFAULT_SEVERITY["duplicate_key"]
    severity: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_SEVERITY))


def _need(type_: str = TEXT, **kw) -> ColumnSpec:
    return ColumnSpec(type_, required=True, **kw)


def _may(type_: str = TEXT) -> ColumnSpec:
    return ColumnSpec(type_)


def default_contracts() -> dict[str, TableSpec]:
    """The eight-table shop contract: keys, types, required columns, value lists, references."""
    return {
        "orders": TableSpec(
            ("order_id",),
            {
                "order_id": _need(),
                "customer_id": _need(),
                "order_status": _need(allowed=ORDER_STATUSES),
                "order_purchase_timestamp": _need(TIME),
                "order_approved_at": _may(TIME),
                "order_delivered_carrier_date": _may(TIME),
                "order_delivered_customer_date": _may(TIME),
                "order_estimated_delivery_date": _need(TIME),
            },
            (ForeignKey("customer_id", "customers", "customer_id"),),
        ),
        "order_items": TableSpec(
            ("order_id", "order_item_id"),
            {
                "order_id": _need(),
                "order_item_id": _need(INT),
                "product_id": _need(),
                "seller_id": _need(),
                "shipping_limit_date": _need(TIME),
                "price": _need(CENTS),
                "freight_value": _need(CENTS),
            },
            (
                ForeignKey("order_id", "orders", "order_id"),
                ForeignKey("product_id", "products", "product_id", "medium"),
                ForeignKey("seller_id", "sellers", "seller_id", "medium"),
            ),
        ),
        "order_payments": TableSpec(
            ("order_id", "payment_sequential"),
            {
                "order_id": _need(),
                "payment_sequential": _need(INT),
                "payment_type": _need(allowed=PAYMENT_TYPES),
                "payment_installments": _need(INT),
                "payment_value": _need(CENTS),
            },
            (ForeignKey("order_id", "orders", "order_id"),),
        ),
        "order_reviews": TableSpec(
            ("review_id",),
            {
                "review_id": _need(),
                "order_id": _need(),
                "review_score": _need(INT, allowed=(1, 2, 3, 4, 5)),
                "review_comment_title": _may(),
                "review_comment_message": _may(),
                "review_creation_date": _need(TIME),
                "review_answer_timestamp": _need(TIME),
            },
            key_severity="medium",
        ),
        "customers": TableSpec(
            ("customer_id",),
            {
                "customer_id": _need(),
                "customer_unique_id": _need(),
                "customer_zip_code_prefix": _need(),
                "customer_city": _need(),
                "customer_state": _need(allowed=STATE_CODES),
            },
        ),
        "products": TableSpec(
            ("product_id",),
            {
                "product_id": _need(),
                "product_category_name": _may(),
                # two of the source headers are misspelled; they are data, so they stay
                "product_name_lenght": _may(INT),
                "product_description_lenght": _may(INT),
                "product_photos_qty": _may(INT),
                "product_weight_g": _may(INT),
                "product_length_cm": _may(INT),
                "product_height_cm": _may(INT),
                "product_width_cm": _may(INT),
            },
            (ForeignKey("product_category_name", "category_translation", "product_category_name", "medium"),),
        ),
        "sellers": TableSpec(
            ("seller_id",),
            {
                "seller_id": _need(),
                "seller_zip_code_prefix": _need(),
                "seller_city": _need(),
                "seller_state": _need(),
            },
        ),
        "category_translation": TableSpec(
            ("product_category_name",),
            {
                "product_category_name": _need(),
                "product_category_name_english": _need(),
            },
        ),
    }


def contracts_from(document: Mapping) -> dict[str, TableSpec]:
    """Contracts from a parsed YAML or JSON document.

    ``defaults.severity`` maps check names to severities.  Each entry of ``tables`` has ``primary_key``,
    ``columns`` (name -> ``type``, ``nullable``, ``allowed``, ``severity``), and optionally
    ``primary_key_severity`` and ``foreign_keys`` (``column``, ``references: table.column``, ``severity``).
    """
    severity = {**DEFAULT_SEVERITY, **document.get("defaults", {}).get("severity", {})}
    out = {}
    for table, spec in document["tables"].items():
        references = []
        for fk in spec.get("foreign_keys", ()):
            ref_table, ref_column = fk["references"].split(".")
            references.append(
                ForeignKey(fk["column"], ref_table, ref_column, fk.get("severity", severity["orphan_foreign_key"]))
            )
        out[table] = TableSpec(
            tuple(spec["primary_key"]),
            {
                name: ColumnSpec(
                    c.get("type", TEXT), not c.get("nullable", True), tuple(c.get("allowed", ())), c.get("severity")
                )
                for name, c in spec["columns"].items()
            },
            tuple(references),
            spec.get("primary_key_severity", severity["duplicate_key"]),
            severity,
        )
    return out


def with_allowed(contracts: dict[str, TableSpec], table: str, column: str, allowed: tuple) -> dict[str, TableSpec]:
    """Copy of the contracts with another value list for one column."""
    spec = contracts[table]
    columns = dict(spec.columns)
    columns[column] = replace(columns[column], allowed=tuple(allowed))
    return {**contracts, table: replace(spec, columns=columns)}


def count_checks(contracts: dict[str, TableSpec], business_groups: int = 7) -> int:
    """Number of checks a contract asks for: generic ones plus the business rule groups."""
    n = business_groups
    for spec in contracts.values():
        n += 1 + len(spec.foreign_keys)
        for c in spec.columns.values():
            n += int(c.required) + int(c.type != TEXT) + int(bool(c.allowed))
    return n
