"""Numbering and running totals against plain windows, on groups that hold much of the table."""

from __future__ import annotations

import statistics
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallybook.operators import checks, ordered
from tallybook.operators.checks import UniqueKey, duplicate_keys, sequence_gaps


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 rows; key 'hot' owns a third of them and one amount is shared by a third."""
    return spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("key"),
        F.when(F.col("id") % 3 == 1, F.lit("7.25")).otherwise(F.abs(F.hash("id") % 50000) / 100).cast("decimal(12,2)").alias("amount"),
    ).cache()


def test_running_total_equals_plain_window(spark, skewed):
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select("id", F.sum("amount").over(w).alias("want"))
    got = ordered.running_total(skewed, ["key"], ordered.value_band(F.col("id"), 100), [F.col("id")], F.col("amount"), "got")
    assert got.count() == 6000
    assert got.join(plain, "id").where("got <> want or got is null").count() == 0


def test_running_total_descending(spark, skewed):
    w = Window.partitionBy("key").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select("id", F.count("id").over(w).alias("want"))
    got = ordered.running_total(skewed, ["key"], ordered.value_band(F.col("id"), 64), [F.col("id").desc()], F.lit(1), "got", descending=True)
    assert got.join(plain, "id").where("got <> want").count() == 0


def test_dense_rank_equals_plain_window(spark, skewed, monkeypatch):
    monkeypatch.setattr(ordered, "MONEY_BAND", 20)
    w = Window.partitionBy("key").orderBy(F.col("amount").desc())
    plain = skewed.select("key", "amount", F.dense_rank().over(w).alias("want")).distinct()
    got = ordered.dense_rank_desc(skewed, ["key"], "amount", "got")
    assert got.count() == plain.count()
    assert got.join(plain, ["key", "amount"]).where("got <> want").count() == 0


def test_previous_value_crosses_bands(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 5, 99, 100, 350, 1000)] + [("b", 401), ("b", 7)], "g string, v int")
    got = {(r.g, r.v): r.p for r in ordered.previous_value(df, ["g"], ordered.value_band(F.col("v"), 100), "v", "p", 0).collect()}
    assert got == {("a", 1): 0, ("a", 2): 1, ("a", 5): 2, ("a", 99): 5, ("a", 100): 99, ("a", 350): 100, ("a", 1000): 350,
                   ("b", 7): 0, ("b", 401): 7}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-500, 500)), min_size=1, max_size=60))
def test_median_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r.g: r.m for r in ordered.exact_median(df, ["g"], "v", 10, "m").collect()}
    want = {g: float(statistics.median([v for h, v in rows if h == g])) for g in {g for g, _ in rows}}
    assert got == want


def test_median_without_group_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (4,)], "v int")
    assert ordered.exact_median(df, [], "v", 10, "m").first().m == 2.5


def test_positions_and_running_sum_over_a_whole_table(spark, skewed, freeze):
    order = [F.col("amount").desc(), F.col("id").asc()]
    w = Window.orderBy(*order)
    plain = skewed.select(
        "id", F.row_number().over(w).alias("want"), F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("want_sum")
    )
    got = ordered.ranged_positions(skewed, order, freeze, "t", "got", ("amount", "so_far", "total"))
    assert got.select("got").distinct().count() == 6000
    assert got.join(plain, "id").where("got <> want or so_far <> want_sum").count() == 0
    assert got.agg(F.max("so_far") == F.max("total")).first()[0]


def test_positions_of_an_empty_table(spark, skewed, freeze):
    assert ordered.ranged_positions(skewed.where("id < 0"), [F.col("id")], freeze, "e", "n", ("amount", "s", "t")).count() == 0


def test_duplicates_of_a_hot_key_are_numbered_across_bands(spark, monkeypatch):
    monkeypatch.setattr(ordered, "IDS_PER_BAND", 50)
    df = spark.range(1, 901).select(
        F.col("id").alias("_row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    rows = duplicate_keys([UniqueKey(df, "t", ("k",), "high")]).orderBy("record_id").collect()
    assert len(rows) == 299
    assert rows[0].record_id == 6 and rows[0].reason == "key (k) appears 300 times; this is copy 2"
    assert rows[-1].record_id == 900 and rows[-1].reason == "key (k) appears 300 times; this is copy 300"


def test_keys_with_separators_stay_apart(spark):
    df = spark.createDataFrame([(1, "a|b", "c"), (2, "a", "b|c")], "_row_id long, x string, y string")
    assert duplicate_keys([UniqueKey(df, "t", ("x", "y"), "high")]).count() == 0


def test_same_key_in_two_tables_is_no_duplicate(spark):
    a = spark.createDataFrame([(1, "k")], "_row_id long, x string")
    b = spark.createDataFrame([(1, "k", "")], "_row_id long, x string, y string")
    assert duplicate_keys([UniqueKey(a, "a", ("x",), "high"), UniqueKey(b, "b", ("x", "y"), "low")]).count() == 0


def test_sequence_gap_of_a_hot_order(spark, monkeypatch):
    monkeypatch.setattr(ordered, "IDS_PER_BAND", 50)
    seqs = [i for i in range(1, 401) if i not in (50, 51, 149, 200)]
    df = spark.createDataFrame([(i, "hot", s) for i, s in enumerate(seqs, 1)] + [(900, "o", 2), (901, "o", 2), (902, None, 3)],
                               "_row_id long, order_id string, payment_sequential int")
    got = {(r.record_key, r.reason.split("jumps ")[1]) for r in sequence_gaps(df).collect()}
    assert got == {("hot|52", "from 49 to 52"), ("hot|150", "from 148 to 150"), ("hot|201", "from 199 to 201"),
                   ("o|2", "from 0 to 2"), ("<null>|3", "from 0 to 3")}
    assert {r.record_id for r in sequence_gaps(df).where("record_key = 'o|2'").collect()} == {900}


def test_money_stays_decimal(spark, skewed, freeze):
    got = ordered.ranged_positions(skewed, [F.col("id")], freeze, "d", "n", ("amount", "s", "t"))
    assert isinstance(got.first().s, Decimal)


def test_numbering_a_table_takes_one_shuffle(spark, skewed):
    """The written ranges hold each row's place; reading the numbers back moves no row."""
    seen = []

    def keep(label, df):
        from tallybook.sources.stage import Stages

        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return Stages(spark).freeze(label, df)

    out = ordered.ranged_positions(skewed, [F.col("amount").desc(), F.col("id")], keep, "one", "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert seen[0].count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in seen[0]
    left = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in left and "Window" not in left


def test_hash_filter_is_bounded_and_loses_no_key(spark):
    keys = spark.range(5000).select((F.col("id") * 7).alias("k"))
    rows = spark.range(40000).select(F.col("id").alias("k"))
    for bits in (64, 1 << 12, 1 << 20):
        held = rows.where(checks.hash_filter(keys, ["k"], bits))
        assert held.join(keys, "k").count() == 5000
        assert held.count() <= (40000 if bits < 1 << 20 else 5600)
    assert rows.where(checks.hash_filter(keys.limit(0), ["k"])).count() == 0


def test_only_rows_with_repeated_hashes_reach_the_second_pass(spark):
    """A third of the rows share one key; the rest is unique and is not joined."""
    df = spark.range(1, 3001).select(F.col("id").alias("_row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"))
    out = duplicate_keys([UniqueKey(df, "t", ("k",), "high")])
    assert out.count() == 999
    assert "getbit" in out._jdf.queryExecution().optimizedPlan().toString()


def test_hash_filter_is_no_constant_of_the_plan(spark):
    """The bits of a filter must not be copied into the text of every plan that uses it."""
    rows = spark.range(10_000).select(F.col("id").cast("string").alias("k"))
    out = rows.where(checks.hash_filter(rows.where("id % 7 = 0"), ["k"]))
    assert len(out._jdf.queryExecution().toString()) < 20_000


def test_second_passes_start_from_what_was_written(spark, freeze):
    """Tables are scanned by the first pass and for the rows that are found, and each parent column once."""
    parent = spark.range(100).select(F.col("id").cast("string").alias("p"))
    child = spark.range(300).select((F.col("id") + 1).alias("_row_id"), F.col("id").cast("string").alias("a"), F.when(F.col("id") % 2 == 0, (F.col("id") + 50).cast("string")).alias("b"))
    refs = [checks.Reference(child, "t", ("a",), c, parent, "p", f"orphan_{c}", "high", f"{c} ", " is unknown") for c in "ab"]
    written = {}
    out = checks.orphans(refs, lambda name, df: written.setdefault(name, freeze(f"second_{name}", df)), "orphans")
    got = sorted((r.check_name, r.record_id, r.reason) for r in out.collect())
    want = [("orphan_a", i + 1, f"a {i} is unknown") for i in range(100, 300)]
    want += [("orphan_b", i + 1, f"b {i + 50} is unknown") for i in range(50, 300, 2)]
    assert got == sorted(want) and written["orphans"].count() == 225
    assert sorted(r.record_id for r in checks.orphans(refs).collect()) == sorted(i for _, i, _ in want)
    twice = child.union(child.where("_row_id <= 5").withColumn("_row_id", F.col("_row_id") + 1000))
    rows = duplicate_keys([UniqueKey(twice, "t", ("a",), "high")], lambda name, df: written.setdefault(name, freeze(f"second_{name}", df)), "keys")
    assert sorted(r.record_id for r in rows.collect()) == list(range(1001, 1006)) and written["keys"].count() == 10


def test_a_key_with_many_copies_is_numbered_as_one_with_few(spark, freeze, monkeypatch):
    """Few copies meet in one shuffle by their hash; only keys over the limit are numbered in stretches."""
    monkeypatch.setattr(ordered, "IDS_PER_BAND", 50)
    rows = spark.range(1, 601).select(
        F.col("id").alias("_row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 150).cast("string")).alias("k")
    )
    got = {}
    for limit in (20, 1000):
        keep = lambda name, df, limit=limit: freeze(f"{name}_{limit}", df)
        out = duplicate_keys([UniqueKey(rows, "t", ("k",), "high")], keep, "many", limit)
        got[limit] = sorted((r.record_id, r.reason) for r in out.collect())
        final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning(hash") == 1
    assert got[20] == got[1000] and len(got[20]) == 600 - 1 - 100
    assert got[20][-1] == (600, "key (k) appears 200 times; this is copy 200")


def test_hot_hashes_are_those_over_the_limit(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 300, -1).when(F.col("id") < 500, -2).otherwise(F.col("id")).alias("h"))
    assert sorted(checks.hot_hashes(rows, F.col("h"), 250)) == [-1]
    assert sorted(checks.hot_hashes(rows, F.col("h"), 199)) == [-2, -1]
    assert checks.hot_hashes(rows, F.col("h"), 300) == [] and checks.hot_hashes(rows.limit(0), F.col("h"), 1) == []
