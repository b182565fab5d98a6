"""Shared folder, written intermediate tables and word rules of the operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Only a local master without the setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallybook-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # folders of the tables that ``freeze`` handed out

#: For tables that hold whole texts: two thirds of the bytes that Spark's usual codec leaves of them.
TEXT_CODEC = "zstd"


def freeze(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, and a lost executor costs no earlier step."""
    path = new_folder(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def remove(*tables: DataFrame) -> None:
    """Delete tables as ``freeze`` returned them.  All that reads them must have been written or collected before."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop(t))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.translate(_ASCII_LOWER) if not text.isascii() else text.lower()


def words(text: str | None) -> list[str]:
    """The words of a text; none for NULL.  (``str.split`` also splits at other characters.)"""
    if not text:
        return []
    return text.split() if text.isascii() and not _OTHER.search(text) else WORD_RE.findall(text)


_OTHER = re.compile(r"[\x1c-\x1f]")


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, *results: str) -> list[Column]:
    """The columns of ``df`` that are not named like a result; the result replaces those."""
    gone = {r.lower() for r in results}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
