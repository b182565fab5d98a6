"""Input manifest check: SHA-256 and row count per file."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


CHUNK = 8 << 20


class FileDigests(DataSource):
    """SHA-256 of listed files of a folder: one partition a file, read as a stream.  A file that is not there gives no row.

    Options: folder (a path or a URI that pyarrow's file systems know), files (JSON list of names), chunk (bytes read at once).
    """

    @classmethod
    def name(cls) -> str:
        return "tallybook_digests"

    def schema(self) -> str:
        return "file string, sha256 string"

    def reader(self, schema) -> DataSourceReader:
        return _DigestReader(dict(self.options))


class _DigestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in json.loads(self.options["files"])]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        import hashlib

        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(self.options["folder"])
        path = f"{folder.rstrip('/')}/{partition.value}"
        if store.get_file_info(path).type != fs.FileType.File:
            return
        digest = hashlib.sha256()
        with store.open_input_stream(path) as stream:
            while part := stream.read(int(self.options["chunk"])):
                digest.update(part)
        yield partition.value, digest.hexdigest()


def manifest_report(
    spark: SparkSession, folder: str, expected: Mapping[str, tuple[str, int]], multi_line: bool = True, chunk: int = CHUNK
) -> DataFrame:
    """One row per expected file: found checksum and rows beside the expected ones, and a status.

    The manifest is a short list written by hand; files are hashed and counted on the executors, each file by one task that reads
    it in chunks of ``chunk`` bytes, so files of any size take the same memory.
    """
    listed = spark.createDataFrame(
        [(n, digest, int(rows)) for n, (digest, rows) in expected.items()],
        "file string, expected_sha256 string, expected_rows long",
    )
    # only listed files are opened; ``?`` stands for signs that a file pattern reads otherwise
    only = "{" + ",".join(re.sub(r"[^A-Za-z0-9_. -]", "?", n) for n in expected) + "}"
    spark.dataSource.register(FileDigests)
    options = {"folder": folder, "files": json.dumps(list(expected)), "chunk": str(chunk)}
    sums = spark.read.format(FileDigests.name()).options(**options).load()
    rows = (
        spark.read.schema("line string")
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("pathGlobFilter", only)
        .csv(folder)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    status = (
        F.when(F.col("sha256").isNull(), "missing")
        .when(F.col("sha256") != F.col("expected_sha256"), "checksum differs")
        .when(F.coalesce("rows", F.lit(0)) != F.col("expected_rows"), "row count differs")
        .otherwise("ok")
    )
    return (
        listed.join(sums, "file", "left")
        .join(rows, "file", "left")
        .select("file", "sha256", "expected_sha256", "rows", "expected_rows", status.alias("status"))
    )


def verify_manifest(spark: SparkSession, folder: str, expected: Mapping[str, tuple[str, int]], multi_line: bool = True) -> None:
    """Raise ``ValueError`` naming every file that is missing or differs."""
    bad = [
        f"{r.file}: {r.status}"
        for r in manifest_report(spark, folder, expected, multi_line).where("status <> 'ok'").orderBy("file").collect()
    ]
    if bad:
        raise ValueError("; ".join(bad))
