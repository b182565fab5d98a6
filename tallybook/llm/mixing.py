"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

A source's target is its share of the budget by weight, but never above ``max_epochs`` times its size; what is cut
off goes to the other sources by weight until none is above.  The fixed point has a closed form: with sources sorted by
cap over weight, a first part of them is capped and the rest share what is left.  One row per source is all this needs.

Every document of a source is then taken ``floor(target / size)`` times whole; the rest of the target is a fractional
repetition: documents in the order of a seeded hash, until the running size comes nearest to what is missing.  The cut
is found by narrowing (4096 hash ranges, 4096 ranges inside the one that is cut, documents inside that), so no window
sees more than one narrow range however large a source is.

Cases: a NULL or empty text has size 0 and is taken 0 times its size; a NULL source is a source of its own, the last
one; an empty table gives no rows; rows that share an id are taken together; further columns stay untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
_RANGE_BITS = 12


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: key, source_size, target, whole repetitions and words of the fractional one.

    ``sizes`` has columns source, size.  Windows here see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*[F.lit(int(w)) for w in weights])
    per = per.withColumn("weight", F.get(kinds, (rank % len(weights)).cast("int")).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_first())
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(up_to), F.lit(0)))
        .withColumn("left_weight", F.col("weights") - F.coalesce(F.sum("weight").over(up_to), F.lit(0)))
    )
    # a source is capped if its share of what the smaller ones leave reaches its cap
    capped = F.col("cap") * F.col("left_weight") <= F.col("weight") * F.col("left_words")
    per = per.withColumn("capped", capped)
    free = F.when(~F.col("capped"), F.struct(F.col("left_weight").alias("w"), F.col("left_words").alias("n")))
    per = per.withColumn("free", F.max(free).over(whole))  # the first uncapped source leaves the most weight
    share = (F.col("weight") * F.col("free.n")) / F.col("free.w")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share.cast("double"))
    per = per.withColumn("target", target)
    times = (F.col("weight") * F.col("free.n")).cast("long")
    unit = (F.col("free.w") * F.col("source_size")).cast("long")
    reps = F.when(F.col("capped"), F.lit(max_epochs)).otherwise(F.floor(F.try_divide(times - times % unit, unit)))
    per = per.withColumn("whole", F.coalesce(reps, F.lit(0)).cast("int"))
    goal = F.when(F.col("capped"), F.lit(0.0)).otherwise(F.col("target") - F.col("whole") * F.col("source_size"))
    return per.select("source", "source_size", "target", "whole", goal.alias("goal"))


def _key(source: str = "source"):
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def _cut(units: DataFrame, by: str) -> DataFrame:
    """Per key the first unit in order of ``by`` that is not taken in full, and the words taken before it.

    ``units``: key, goal, before, ``by``, size.  A unit is taken while that brings the sum nearer to the goal.
    """
    over = Window.partitionBy("key").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = F.col("before") + F.sum("size").over(over)
    kept = units.withColumn("done", done).where(F.col("done") > F.col("goal"))
    first = Window.partitionBy("key").orderBy(by)
    return (
        kept.withColumn("_n", F.row_number().over(first)).where("_n = 1")
        .select("key", "goal", F.col(by), (F.col("done") - F.col("size")).alias("before"))
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: id, size, source_size, target, whole, extra (0 or 1), taken."""
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))), 1, 15), 16, 10)
    sizes = freeze(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
            place.cast("long").alias("place"),
        ),
        "mix-sizes",
    )
    targets = freeze(source_targets(sizes, weights, max_epochs).withColumn("key", _key()), "mix-targets")
    rows = sizes.withColumn("key", _key())
    rows = rows.withColumn("r1", F.shiftright("place", 60 - _RANGE_BITS)).withColumn("r2", F.shiftright("place", 60 - 2 * _RANGE_BITS))
    goals = targets.select("key", "goal", F.lit(0).cast("long").alias("before")).where("goal > 0")
    for by in ("r1", "r2", "place"):
        units = rows.groupBy("key", by).agg(F.sum("size").alias("size")).join(goals, "key")
        goals = freeze(_cut(units, by), f"mix-{by}")
        rows = rows.join(goals.select("key", by), ["key", by])
    # goals: the first place at which the sum passes the goal; it is taken if that is nearer than stopping before it
    last = rows.groupBy("key").agg(F.sum("size").alias("at"))
    cut = goals.join(last, "key").select(
        "key", F.when(2 * F.col("before") + F.col("at") < 2 * F.col("goal"), F.col("place")).otherwise(F.col("place") - 1).alias("cut")
    )
    plan = targets.drop("source").join(cut, "key", "left")
    extra = F.when((F.col("goal") > 0) & (F.col("cut").isNull() | (F.col("place") <= F.col("cut"))), 1).otherwise(0)
    out = sizes.withColumn("key", _key()).join(plan, "key").withColumn("extra", extra)
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target", "whole", "extra",
        (F.col("size") * (F.col("whole") + F.col("extra"))).cast("long").alias("taken"),
    )
