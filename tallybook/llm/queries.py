"""One registered query per operator, on its whole table, with the operator's production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .conversations import repair_report
from .decontaminate import find_leaks
from .html_wrappers import extract
from .jaccard_join import similar_documents
from .line_dedup import dedup_lines
from .mixing import mix
from .neighbours import search
from .packing import pack_report
from .phrases import phrase_report
from .quality import classify
from .secrets import Ledger, digest
from .tokens import token_report
from .url_filter import judge_urls


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is one version at the path doc_id; the ledger starts empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(Ledger(spark).scan(docs))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of the page with the same id are its outcome: good if of quality and not toxic."""
    labels = table(spark, sf_dir, "labels")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), good.alias("good"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "whole", "extra")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, with their grades."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).where("keep").select("doc_id", "expected_grade", "tail")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_report(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_report(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_html_text": op2_html_text,
    "op3_decontamination": op3_decontamination,
    "op4_secret_scan": op4_secret_scan,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_url_filter": op7_url_filter,
    "op8_line_dedup": op8_line_dedup,
    "op9_source_mix": op9_source_mix,
    "op10_quality": op10_quality,
    "op11_packing": op11_packing,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_conversation_repair": op13_conversation_repair,
}
