from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

from tallybook.contracts import count_checks, contracts_from, default_contracts
from tallybook.functions.casts import DATE_PREFIX, to_contract_type
from tallybook.functions.numeric import half_up, pct
from tallybook.functions.text import record_key, sentence

TEXTS = ["12", " 12 ", "12.5", "1e2", "12.345", "abc", "", None, "2017", "2017-01-02", "2017-01-02 03:04:05", "99999999999", "-3", "0.5", "-0.5"]


def cast_all(spark, kind, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return [r.v for r in df.select("i", to_contract_type(F.col("t"), kind, **kw).alias("v")).orderBy("i").collect()]


def sql_all(kind):
    con = duckdb.connect()
    return [con.execute(f"select try_cast(? as {kind})", [t]).fetchone()[0] for t in TEXTS]


def test_integer_cast_agrees_with_sql(spark):
    assert cast_all(spark, "INTEGER") == sql_all("INTEGER")


def test_strict_integer_refuses_fractions(spark):
    got = dict(zip(TEXTS, cast_all(spark, "INTEGER", strict=True)))
    assert got["12"] == 12 and got["12.5"] is None and got["1e2"] is None


def test_decimal_cast_agrees_with_sql(spark):
    got = dict(zip(TEXTS, cast_all(spark, "DECIMAL(12,2)")))
    want = dict(zip(TEXTS, sql_all("DECIMAL(12,2)")))
    assert got["12.345"] == Decimal("12.35") and got["abc"] is None
    for t in TEXTS:
        if t != "99999999999":  # one digit too many: both refuse
            assert got[t] == want[t], t


def test_timestamp_cast_refuses_a_bare_year(spark):
    got = dict(zip(TEXTS, cast_all(spark, "TIMESTAMP")))
    assert got["2017"] is None and got["12"] is None
    assert got["2017-01-02"] == dt.datetime(2017, 1, 2)
    assert got["2017-01-02 03:04:05"] == dt.datetime(2017, 1, 2, 3, 4, 5)


def test_rounding_follows_binary_value(spark):
    con = duckdb.connect()
    values = [0.285, 2.675, 1.005, -0.285, -2.5, 0.5, 3.125, 12.34565]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.x for r in df.select(half_up(F.col("v"), 2).alias("x")).collect()]
    assert got == [con.execute("select round(?::double, 2)", [v]).fetchone()[0] for v in values]


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(pct(F.lit(1), F.lit(0), 2).alias("x")).first().x is None


def test_texts_never_vanish(spark):
    df = spark.createDataFrame([(None, "b")], "a string, b string")
    row = df.select(record_key([F.col("a"), F.col("b")]).alias("k"), sentence("a is ", F.col("a")).alias("s")).first()
    assert (row.k, row.s) == ("<null>|b", "a is <null>")


def test_contract_has_81_checks():
    assert count_checks(default_contracts()) == 81


def test_contract_from_document():
    doc = {
        "defaults": {"severity": {"required_null": "low"}},
        "tables": {
            "a": {
                "primary_key": ["id"],
                "primary_key_severity": "medium",
                "columns": {"id": {"type": "VARCHAR", "nullable": False}, "n": {"type": "INTEGER", "allowed": [1, 2], "severity": "low"}},
                "foreign_keys": [{"column": "n", "references": "b.n", "severity": "medium"}],
            }
        },
    }
    spec = contracts_from(doc)["a"]
    assert spec.key_severity == "medium" and spec.severity["required_null"] == "low" and spec.severity["type_mismatch"] == "high"
    assert spec.columns["id"].required and not spec.columns["n"].required and spec.columns["n"].allowed == (1, 2)
    assert spec.foreign_keys[0].ref_table == "b" and spec.foreign_keys[0].severity == "medium"


def test_timestamps_are_those_of_the_pattern(spark):
    """The look at two hyphens only saves the pattern; it decides nothing else."""
    texts = ["2017-01-02", "2017-1-2", " 2017-01-02", "\t2017-01-02 03:04", "2017-01-", "2017-01", "2017-01-0", "12017-01-02", "-2017-01-02", "2017-01-02T", "017--01-02",
             "2017-01-02T03:04:05.123456", "    -  -", "abcd-ef-gh", "2017-13-02", "20170-1-02", "+2017-01-02", "2017-01-02 25:00:00", "", None, "03:04:05", "now"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.when(F.col("t").rlike(DATE_PREFIX), F.col("t").try_cast("timestamp_ntz"))
    rows = df.select("t", to_contract_type(F.col("t"), "TIMESTAMP").alias("got"), plain.alias("want")).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows] and sum(r.got is not None for r in rows) == 5
