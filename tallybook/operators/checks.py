"""Checks that turn rows into exceptions.  Every function returns the same columns (``EXCEPTION``).

Row rules of one table run in one pass: each rule yields a struct or NULL, the hits are kept in an array and
unfolded.  Only duplicates, orphans and sequence gaps need a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NULL_TEXT, record_key, sentence
from .ordered import Freeze, id_band, previous_value, running_total

EXCEPTION = ("table_name", "record_id", "record_key", "check_name", "reason", "severity")
# Exceptions travel with the order they touch, so nothing has to join back for it.
CARRIED = (*EXCEPTION, "order_id")


@dataclass(frozen=True)
class RowRule:
    """A condition on one row: when it is true the row gets an exception."""

    check: str
    severity: str
    when: Column
    reason: Column
    key: Column


def flag_rows(df: DataFrame, table: str, rules: Sequence[RowRule], order_id: Column) -> DataFrame:
    """Evaluate all rules in one pass over the rows.

    Each rule yields a struct or NULL and the structs are unfolded.  Everything stays in generated code (an array
    filter with a lambda would not), and the casts below are done once per row (a filter on the rules would be
    pushed under them and repeat them for every rule).
    """
    hits = F.array(
        *[
            F.when(
                r.when,
                F.struct(
                    r.key.alias("record_key"),
                    F.lit(r.check).alias("check_name"),
                    r.reason.alias("reason"),
                    F.lit(r.severity).alias("severity"),
                ),
            )
            for r in rules
        ]
    )
    return (
        df.select(F.col("_row_id").alias("record_id"), order_id.cast("string").alias("order_id"), F.explode(hits).alias("hit"))
        .where(F.col("hit").isNotNull())
        .select(
            F.lit(table).alias("table_name"),
            "record_id",
            *[F.col(f"hit.{c}").alias(c) for c in ("record_key", "check_name", "reason", "severity")],
            "order_id",
        )
    )


def _choose(code: Column, texts: Sequence[str]) -> Column:
    """The text that belongs to a small code 0, 1, 2, ..."""
    return F.element_at(F.array(*[F.lit(t) for t in texts]), code + 1)


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


#: Bits of the filter that keeps rows out of the second pass; its size does not depend on the data.
FILTER_BITS = 1 << 22


def hash_filter(keys: DataFrame, columns: Sequence[str], bits: int = FILTER_BITS) -> Column:
    """A condition that holds for every row whose ``columns`` are among ``keys``, and for few others.

    The keys are hashed into a bitmap of a fixed size, which comes to the driver (``bits`` / 64 numbers at most) and goes out as the
    one row of a scalar subquery.  Plans name the subquery only: a constant would be copied into the text of each plan, once
    for every table under a union.  A full bitmap lets all rows through; whoever uses it decides exactly afterwards.
    """
    place = F.xxhash64(*columns).bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    if not words.num_rows:
        return F.lit(False)
    held = np.zeros(bits // 64, dtype=np.int64)
    held[words["word"].to_numpy()] = words["bits"].to_numpy()
    row = pa.table({"held": pa.array([held], pa.list_(pa.int64()))})
    bitmap = keys.sparkSession.createDataFrame(row).scalar()
    return F.getbit(F.get(bitmap, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1


#: Rows of one key that are too many for a single task, and how the search for such keys is bounded.
HOT_ROWS = 100_000
HOT_KEYS = 4096
HOT_BUCKETS = 1 << 16


def hot_hashes(rows: DataFrame, hash_: Column, least: int = HOT_ROWS) -> list[int]:
    """Hashes of keys with more than ``least`` rows, at most ``HOT_KEYS`` of them.

    Rows are counted in a fixed number of buckets first; only buckets that are large enough are looked at hash by hash.
    """
    bucket = hash_.bitwiseAND(F.lit(HOT_BUCKETS - 1))
    buckets = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows")).toArrow()
    sizes = buckets["rows"].to_numpy()
    least = max(least, int(sizes.sum()) // HOT_KEYS)
    large = buckets["bucket"].to_numpy()[sizes > least].tolist()
    if not large:
        return []
    counts = rows.where(bucket.isin(large)).groupBy(hash_.alias("hash")).agg(F.count(F.lit(1)).alias("rows"))
    return [r.hash for r in counts.where(F.col("rows") > least).collect()]


@dataclass(frozen=True)
class UniqueKey:
    """Columns of one table that must be unique together."""

    rows: DataFrame
    table: str
    columns: tuple[str, ...]
    severity: str


def duplicate_keys(
    keys: Sequence[UniqueKey], freeze: Freeze | None = None, label: str = "repeated_keys", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Flag copies 2..n of a key.  Rows with an incomplete key are left to ``required_null``.

    The keys of all tables go through one pipeline.  A first pass counts hashes of 8 bytes (combined before the shuffle); rows whose
    hash comes once are done.  The others are counted by the keys themselves and numbered: one shuffle brings the few copies of a key
    together, and a hot key (more than ``hot_rows`` rows) is numbered in stretches of row ids.  ``freeze`` writes those others
    once, so the tables are scanned twice in all and the plans of the numbering start from one small table.
    """
    widest = max(len(k.columns) for k in keys)
    names = [f"key_{i}" for i in range(widest)]
    parts = []
    for code, k in enumerate(keys):
        filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k.columns])
        # shorter keys are padded; the code keeps the keys of different tables apart
        padded = [F.col(c) for c in k.columns] + [F.lit("")] * (widest - len(k.columns))
        parts.append(
            k.rows.where(filled).select(F.lit(code).alias("code"), *[p.alias(n) for p, n in zip(padded, names)], "_row_id")
        )
    complete = _stack(parts)
    group = ["code", *names]
    hashes = complete.groupBy(F.xxhash64(*group).alias("hash")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    complete = complete.withColumn("hash", F.xxhash64(*group)).where(hash_filter(hashes, ["hash"]))
    if freeze:
        complete = freeze(label, complete)
    # 0 keeps the second branch in every plan; it is a hash like any other
    is_hot = F.col("hash").isin([0, *hot_hashes(complete, F.col("hash"), hot_rows)])
    one_key = Window.partitionBy("hash", *group)
    few = complete.where(~is_hot).select(
        *group, "_row_id", F.count(F.lit(1)).over(one_key).alias("copies"), F.row_number().over(one_key.orderBy("_row_id")).alias("copy")
    )
    hot = complete.where(is_hot).drop("hash")
    repeated = hot.groupBy(*group).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    many = running_total(hot.join(repeated, group), group, id_band(F.col("_row_id")), [F.col("_row_id")], F.lit(1), "copy")
    numbered = few.unionByName(many.select(*few.columns))
    code = F.col("code")
    width = F.element_at(F.array(*[F.lit(len(k.columns)) for k in keys]), code + 1)
    starts_with_order = [i for i, k in enumerate(keys) if k.columns[0] == "order_id"]
    return numbered.where("copy > 1").select(
        _choose(code, [k.table for k in keys]).alias("table_name"),
        F.col("_row_id").alias("record_id"),
        F.array_join(F.slice(F.array(*names), 1, width), "|").alias("record_key"),
        F.lit("duplicate_key").alias("check_name"),
        sentence(
            "key (", _choose(code, [", ".join(k.columns) for k in keys]), ") appears ", F.col("copies"),
            " times; this is copy ", F.col("copy"),
        ).alias("reason"),
        _choose(code, [k.severity for k in keys]).alias("severity"),
        F.when(code.isin(starts_with_order), F.col("key_0")).alias("order_id"),
    )


@dataclass(frozen=True)
class Reference:
    """A column whose values must exist in a parent column."""

    child: DataFrame
    table: str
    key: tuple[str, ...]
    column: str
    parent: DataFrame
    parent_column: str
    check: str
    severity: str
    before: str
    after: str


def orphans(references: Sequence[Reference], freeze: Freeze | None = None, label: str = "orphan_values") -> DataFrame:
    """Rows whose non-null reference has no parent.

    All references go through one pipeline.  Their distinct values (combined before the shuffle, so a value used
    by a third of the rows is one value) meet the parents in an anti join, each parent column once for all references to
    it.  ``freeze`` writes the orphan values once; a filter of their hashes then keeps all other rows out of the second pass,
    which picks the rows exactly.
    """
    used, known, rows, parents = [], [], [], {}
    for n, r in enumerate(references):
        code, value = F.lit(n).alias("code"), F.col(r.column)
        order_id = F.col("order_id") if "order_id" in r.child.columns else F.lit(None)
        place = (id(r.parent), r.parent_column)
        if place not in parents:
            parents[place] = len(parents)
            known.append(r.parent.select(F.lit(parents[place]).alias("parent"), F.col(r.parent_column).alias("value")))
        parent = F.lit(parents[place]).alias("parent")
        used.append(r.child.where(value.isNotNull()).select(parent, value.alias("value")))
        rows.append(
            r.child.where(value.isNotNull()).select(
                code,
                parent,
                value.alias("value"),
                F.col("_row_id").alias("record_id"),
                record_key([F.col(k) for k in r.key]).alias("record_key"),
                order_id.cast("string").alias("order_id"),
            )
        )
    by = ["parent", "value"]
    lost = _stack(used).distinct().join(_stack(known), by, "left_anti")
    if freeze:
        lost = freeze(label, lost)
    code = F.col("code")
    return _stack(rows).where(hash_filter(lost, by)).join(lost, by, "left_semi").select(
        _choose(code, [r.table for r in references]).alias("table_name"),
        "record_id",
        "record_key",
        _choose(code, [r.check for r in references]).alias("check_name"),
        F.concat(
            _choose(code, [r.before for r in references]), F.col("value"), _choose(code, [r.after for r in references])
        ).alias("reason"),
        _choose(code, [r.severity for r in references]).alias("severity"),
        "order_id",
    )


def sequence_gaps(payments: DataFrame) -> DataFrame:
    """Payments whose sequence number jumps by more than one inside an order (0 precedes the first).

    Copies of one number collapse first; the copy with the smallest row id carries the exception.  Numbers of a
    huge order are compared in stretches.
    """
    seq = "payment_sequential"
    steps = (
        payments.where(F.col(seq).isNotNull())
        .groupBy(F.coalesce("order_id", F.lit(NULL_TEXT)).alias("_order"), seq)
        .agg(F.min("_row_id").alias("_row_id"), F.max("order_id").alias("order_id"))
    )
    stepped = previous_value(steps, ["_order"], id_band(F.col(seq)), seq, "previous", 0)
    reason = sentence("payment_sequential jumps from ", F.col("previous"), " to ", F.col(seq))
    return stepped.where(F.col(seq).cast("long") > F.col("previous") + F.lit(1).cast("long")).select(
        F.lit("order_payments").alias("table_name"),
        F.col("_row_id").alias("record_id"),
        record_key([F.col("order_id"), F.col(seq)]).alias("record_key"),
        F.lit("payment_sequence_gap").alias("check_name"),
        reason.alias("reason"),
        F.lit("low").alias("severity"),
        "order_id",
    )
