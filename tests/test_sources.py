from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tallybook.sources import readers, sinks
from tallybook.sources.manifest import manifest_report, verify_manifest
from tallybook.sources.stage import Stages, shared_folder


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return path


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_is_text_in_file_order(spark, freeze, tmp_path, multi_line):
    note = '"line one\nline two"' if multi_line else "one line"
    write(tmp_path, "t.csv", f'a,b,c\n1,"x, ""quoted""",\n,"",last\n007,{note},9\n', "utf-8-sig")
    rows = readers.land_csv(spark, str(tmp_path / "t.csv"), ["a", "b", "c"], freeze, f"csv{multi_line}", multi_line).orderBy("_row_id").collect()
    assert [r._row_id for r in rows] == [1, 2, 3]
    assert tuple(rows[0])[1:] == ("1", 'x, "quoted"', None)
    assert tuple(rows[1])[1:] == (None, None, "last")
    assert rows[2].a == "007" and rows[2].b == ("line one\nline two" if multi_line else "one line")


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_columns_are_bound_by_name(spark, freeze, tmp_path, multi_line):
    """Each file of a folder has its own header; its order may differ."""
    write(tmp_path, "a.csv", "a,b\n1,2\n3,\n")
    write(tmp_path, "b.csv", "b,a\n5,4\n,6\n", "utf-8-sig")
    write(tmp_path, "c.csv", "b,a\n")
    rows = readers.land_csv(spark, str(tmp_path), ["a", "b"], freeze, f"named{multi_line}", multi_line).orderBy("_row_id").collect()
    assert [tuple(r) for r in rows] == [(1, "1", "2"), (2, "3", None), (3, "4", "5"), (4, "6", None)]


@pytest.mark.parametrize(
    ("header", "message"),
    [("a,b,c", "extra column c"), ("c,a,b", "extra column c"), ("a", "missing column b"), ("a,c", "missing column b"), ("a,a,b", "column a twice")],
)
def test_csv_with_other_columns_is_refused(spark, freeze, tmp_path, header, message):
    write(tmp_path, "good.csv", "b,a\n1,2\n")
    write(tmp_path, "odd.csv", f"{header}\n1,2,3\n")
    with pytest.raises(ValueError, match=f"odd.csv.*{message}"):
        readers.land_csv(spark, str(tmp_path), ["a", "b"], freeze, f"odd{header}".replace(",", ""))


def test_split_csv_files_keep_their_order(spark, freeze, tmp_path):
    """Two files of different size, read in many splits: ids follow path, then position in the file."""
    for name, start, n in (("a.csv", 0, 3000), ("b.csv", 3000, 20000)):
        write(tmp_path, name, "n,pad\n" + "".join(f"{i},{'x' * 20}\n" for i in range(start, start + n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = readers.land_csv(spark, str(tmp_path), ["n", "pad"], freeze, "split", multi_line=False)
        assert df.count() == 23000
        assert df.where("cast(n as long) + 1 <> _row_id").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parquet_row_ids_over_many_files(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(1000).select("id", (F.col("id") * 2).alias("v")).repartition(5).write.parquet(path)
    df = readers.with_row_ids(spark.read.parquet(path))
    assert df.columns == ["_row_id", "id", "v"]
    assert sorted(r._row_id for r in df.collect()) == list(range(1, 1001))
    again = {r.id: r._row_id for r in readers.with_row_ids(spark.read.parquet(path)).collect()}
    assert again == {r.id: r._row_id for r in df.collect()}
    assert {r._row_id for r in df.where("id < 10").collect()} == {again[i] for i in range(10)}


def test_manifest(spark, tmp_path):
    a = write(tmp_path, "a.csv", 'x,y\n1,"two\nlines"\n2,b\n')
    write(tmp_path, "b.csv", "x\n1\n")
    digest = hashlib.sha256(a.read_bytes()).hexdigest()
    good = {"a.csv": (digest, 2)}
    assert [r.status for r in manifest_report(spark, str(tmp_path), good).collect()] == ["ok"]
    verify_manifest(spark, str(tmp_path), good)
    small = manifest_report(spark, tmp_path.as_uri(), good, chunk=3).first()  # read in chunks of three bytes, by a URI
    assert small.sha256 == digest and small.status == "ok"
    plan = manifest_report(spark, str(tmp_path), good)
    assert "b.csv" not in "".join(plan.inputFiles())
    bad = {"a.csv": (digest, 3), "b.csv": ("0" * 64, 1), "c.csv": (digest, 1)}
    got = {r.file: r.status for r in manifest_report(spark, str(tmp_path), bad).collect()}
    assert got == {"a.csv": "row count differs", "b.csv": "checksum differs", "c.csv": "missing"}
    with pytest.raises(ValueError, match="b.csv: checksum differs"):
        verify_manifest(spark, str(tmp_path), bad)


def test_exports_agree(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "line\nbreak", 1.5)], "n int, t string, v double")
    sinks.export_tables({"t": df}, str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/t.parquet")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert any(p.name.endswith(".zstd.parquet") for p in (tmp_path / "t.parquet").iterdir())
    assert {r.t for r in sinks.read_csv(spark, f"{tmp_path}/t.csv").collect()} == {'a "b", c', "line\nbreak"}
    row = sinks.copy_parity(spark, str(tmp_path), ["t"]).first()
    assert (row.parquet_rows, row.csv_rows) == (2, 2)


def test_copy_parity_and_inferred_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", 1.5)], "n int, t string, v double")
    sinks.export_tables({"t": df}, str(tmp_path))
    row = sinks.copy_parity(spark, str(tmp_path), ["t"]).first()
    assert (row.table_name, row.parquet_rows, row.csv_rows) == ("t", 2, 2)
    assert dict(sinks.read_csv(spark, f"{tmp_path}/t.csv").dtypes) == {"n": "int", "t": "string", "v": "double"}


def test_json_keeps_nulls(spark, tmp_path):
    sinks.write_json(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/j")
    lines = [x for p in (tmp_path / "j").glob("part-*") for x in p.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"a": 1, "b": None}]


def test_row_counts(spark):
    got = {r.table_name: r.rows for r in readers.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert got == {"a": 3, "b": 0}


def test_stages_use_the_shared_folder(spark):
    folder = shared_folder(spark)
    stages = Stages(spark)
    assert stages.folder.startswith(folder.rstrip("/"))
    assert Stages(spark).folder != stages.folder
    df = spark.range(5).withColumn("t", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    assert stages.freeze("x", df).dtypes == df.dtypes


def test_stage_folder_is_removed(spark, tmp_path):
    stages = Stages(spark, str(tmp_path))
    assert stages.freeze("x", spark.range(5)).count() == 5
    stages.remove()
    assert list(tmp_path.iterdir()) == []
