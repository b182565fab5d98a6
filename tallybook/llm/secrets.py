"""Secret scans with a ledger of blobs.

A version of a file is (path, text).  Texts are content-addressed: the SHA-256 of the text is the blob, and equal texts
are one blob however many paths and versions carry it.  The ledger holds one row per blob and rule version that was
scanned, with the spans found.  A scan takes the blobs of all historical versions, leaves out the pairs of blob and rule
version that the ledger has, scans the rest once each, appends them to the ledger and joins findings back to all paths.

Cases: a NULL text counts as empty; an empty one has no spans; equal texts share one scan; an empty table gives no rows;
further columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, new_folder, others

RULE_VERSION = "1"
# Kinds in their order, patterns, and the group and least length that a match needs.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.A, 0, 20),
    ("hex", r"[0-9a-f]+", re.A, 0, 24),
)
KINDS = tuple(kind for kind, *_ in RULES)
LEDGER = "blob binary, rules string, spans array<struct<kind:string,start:int,stop:int>>"


def spans_of(text: str | None, rules=RULES) -> list[tuple[str, int, int]]:
    """Spans in code points, by start, then by kind in the rules' order."""
    found = []
    for rank, (kind, pattern, flags, group, least) in enumerate(rules):
        # a run of one class of characters that is too short can't match at all, so its length goes into the pattern
        if group == 0 and pattern.endswith("]+"):
            fixed = len(pattern.split("[")[0])
            pattern = f"{pattern[:-1]}{{{least - fixed},}}"
        for m in re.finditer(pattern, text or "", flags):
            if len(m[group]) >= least:
                found.append((m.start(), rank, kind, m.end()))
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def _scanner(rules) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [[{"kind": k, "start": a, "stop": b} for k, a, b in spans_of(t, rules)] for t in part["text"]]
            yield pd.DataFrame({"blob": part["blob"], "rules": part["rules"], "spans": found})

    return scan


class Ledger:
    """Parquet table of scanned pairs in a folder that all executors share; grows by appending."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or new_folder(spark, "secret-ledger")
        if folder is None:
            self.spark.createDataFrame([], LEDGER).write.parquet(self.folder)

    def read(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.folder)

    def scan(self, versions: DataFrame, text_col: str = "text", rules=RULES, rule_version: str = RULE_VERSION) -> DataFrame:
        """Scan what is new in ``versions``; returns them without text but with blob and spans."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        blob = F.unhex(F.sha2(text, 256))
        fresh = versions.select(blob.alias("blob"), text.alias("text")).dropDuplicates(["blob"])
        known = self.read().where(F.col("rules") == rule_version).select("blob")
        fresh = fresh.join(known, "blob", "left_anti").withColumn("rules", F.lit(rule_version))
        fresh.mapInPandas(_scanner(rules), LEDGER).write.mode("append").parquet(self.folder)
        found = self.read().where((F.col("rules") == rule_version) & (F.size("spans") > 0))
        own, key, spans = (free(versions, x) for x in ("_own", "_key", "_spans"))
        found = found.dropDuplicates(["blob"]).select(F.col("blob").alias(key), F.col("spans").alias(spans))
        rest = others(versions, "blob", "spans", text_col)
        seen = versions.withColumn(own, blob).select(*rest, own)
        none = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
        back = seen.join(found, F.col(own) == F.col(key), "left")
        return back.select(*rest, F.col(own).alias("blob"), F.coalesce(spans, none).alias("spans"))


def span_text(spans) -> F.Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind and the joined spans, from ``Ledger.scan``."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return found.select(
        id_col, *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text("spans").alias("spans"),
    )
