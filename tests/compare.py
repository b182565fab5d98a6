"""Run registered queries and their oracle SQL side by side.

    python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: str = "8", width: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallybook-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    """One spelling for a value of either engine."""
    if isinstance(v, decimal.Decimal):
        return format(v.normalize() + 0, "f")
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return format(decimal.Decimal(repr(v)).normalize() + 0, "f")
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def difference(spark_columns, spark_rows, sql_columns, sql_rows) -> str | None:
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} <> {sorted(sql_columns)}"
    a, b = rows_of(spark_columns, spark_rows), rows_of(sql_columns, sql_rows)
    if len(a) != len(b):
        only_a, only_b = list(set(a) - set(b))[:2], list(set(b) - set(a))[:2]
        return f"rows {len(a)} <> {len(b)}; spark only {only_a}; sql only {only_b}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {sorted(spark_columns)}\n    spark {bad[0][0]}\n    sql   {bad[0][1]}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = session(), oracle(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, folder)
            got = df.collect()
            t1 = time.time()
            note = "rows only"
            if name in sql:
                cur = con.execute(sql[name])
                note = difference(df.columns, got, [d[0] for d in cur.description], cur.fetchall())
            bad = name in sql and note is not None
        except Exception as e:  # report and go on to the next query
            t1, note, bad, got = time.time(), f"{type(e).__name__}: {str(e)[:600]}", True, []
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name:40s} {len(got):7d} rows {t1 - t0:6.2f}s sql {time.time() - t1:5.2f}s {note or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
