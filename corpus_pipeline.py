"""From documents to a training mix: five filtering and weighing stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir), works on all documents that the stages before it kept, and returns the columns of
documents; the last one returns what the mix takes of each document.

Cases: a NULL or empty text is kept by the classifier's thresholds alone and is never a copy, a leak or a repeated line; rows are told apart by a key
of their own, so rows that share an id, or have none, are judged one by one (of equal rows one stays); of linked documents the one with the
smallest id stays, then the first row; an empty table gives no rows; further columns are kept up to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import TEXT_CODEC, free, freeze, table
from tallybook.llm.decontaminate import find_leaks
from tallybook.llm.jaccard_join import similar_documents
from tallybook.llm.line_dedup import dedup_lines
from tallybook.llm.mixing import mix
from tallybook.llm.quality import classify


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classify(docs, table(spark, sf_dir, "labels")).where("keep").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated passages go; a document of which no line is left goes with them."""
    out = dedup_lines(docs)
    empty = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.where(~F.coalesce(empty, F.lit(False))).withColumn("n_chars", size).select(*docs.columns)


def _keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` written with a key of each row."""
    key = free(docs, "_key")
    return freeze(docs.withColumn(key, F.monotonically_increasing_id()), name, TEXT_CODEC), key


def _without(docs: DataFrame, key: str, gone: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``docs`` without some keys; these are written first, so that Spark knows their size before it picks a join."""
    return docs.join(freeze(gone.select(key).distinct(), name), key, "left_anti").select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays: that with the smallest id, of rows with one id the first."""
    held, key = _keyed(docs, "near-rows")
    label, first = free(held, "_label"), free(held, "_first")
    found = freeze(similar_documents(held, key).select(key, F.col("component_id").alias(label)), "near-labels")
    # only rows that are linked with another one are ranked
    linked = found.groupBy(label).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(label)
    rows = found.join(linked, label).join(held.select(key, "doc_id"), key)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key)
    stays = rows.groupBy(label).agg(F.min(place)[key].alias(first)).select(first)
    gone = rows.join(stays, F.col(key) == F.col(first), "left_anti")
    return _without(held, key, gone, docs.columns, "near-duplicates")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    held, key = _keyed(docs, "leak-rows")
    return _without(held, key, find_leaks(held, table(spark, sf_dir, "benchmark"), key), docs.columns, "leaks")


def weigh(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mix(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", weigh),
]

#: Two stages fit a model, which SQL can't express; the tests hold every stage against a version by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
