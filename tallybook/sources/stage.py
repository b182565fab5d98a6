"""Stage tables: results written once to the shared folder and read back.

They play the part of the intermediate tables of a warehouse run: later steps start from a file, lineage is
cut, and a lost executor costs no recomputation of earlier steps.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of its own only for a local master without one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallybook-"))
    return context.getCheckpointDir()


class Stages:
    """Writes named stage tables under one folder of its own and hands out the read-back tables."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        base = (folder or shared_folder(spark)).rstrip("/")
        self.folder = f"{base}/tallybook-{uuid.uuid4().hex}"

    def freeze(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def freeze_parts(self, name: str, parts: Sequence[DataFrame]) -> DataFrame:
        """One table of several parts with the same columns, each written by a query of its own, so that no plan holds them all."""
        for n, part in enumerate(parts):
            self.freeze(f"{name}/part={n}", part)
        return self.spark.read.schema(parts[0].schema).parquet(*[f"{self.folder}/{name}/part={n}" for n in range(len(parts))])

    def remove(self) -> None:
        """Delete the folder with all stage tables; what was read from it can't be read any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
