"""Sources, sinks and zone moves on small files in the shared scratch folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hausprep.plans.zones import import_directory, transfer_zone
from hausprep.session import scratch_path
from hausprep.sinks.files import write_csv_dated
from hausprep.sources import fs
from hausprep.sources.catalog import create_zone, list_tables
from hausprep.sources.files import (
    CSV_OPTIONS, EmptyInput, empty_guard, read_csv_text, scan_csv_excluding, scan_regions)


def write_text(spark, path, text):
    """Write one small text file through Hadoop (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def test_duplicate_header_names(spark):
    d = scratch_path(spark, "dup_header")
    write_text(spark, f"{d}/f.csv", "a,b,a\n1,2,3\n")
    df = read_csv_text(spark, f"{d}/f.csv")
    assert df.columns == ["a", "b", "a_1"] and tuple(df.first()) == ("1", "2", "3")


def test_quoted_cells_round_trip(spark):
    d = scratch_path(spark, "quoted")
    write_text(spark, f"{d}/f.csv", 'k,v\n1,"[""A"", ""B""]"\n2,"line1\nline2"\n3,None \n')
    got = [tuple(r) for r in read_csv_text(spark, f"{d}/f.csv").orderBy("k").collect()]
    assert got == [("1", '["A", "B"]'), ("2", "line1\nline2"), ("3", "None ")]


def test_scan_regions_missing_file(spark):
    d = scratch_path(spark, "regions")
    write_text(spark, f"{d}/data_ab.csv", "x,y\n1,2\n")
    write_text(spark, f"{d}/data_bc.csv", "x,z\n3,4\n")
    res = scan_regions(spark, d, ["ab", "bc", "yt"])
    assert len(res.missing) == 1 and res.missing[0].endswith("data_yt.csv")
    rows = sorted(tuple(r) for r in res.frame.select("x", "y", "z", "source").collect())
    assert rows == [("1", "2", None, "ab"), ("3", None, "4", "bc")]
    with pytest.raises(FileNotFoundError):
        scan_regions(spark, d, ["ab", "yt"], strict=True)


def test_scan_excluding_marker_case_insensitive(spark):
    d = scratch_path(spark, "excl")
    write_text(spark, f"{d}/keep.csv", "x\n1\n")
    write_text(spark, f"{d}/CLEANED_Canada_20240101.csv", "x\n2\n")
    res = scan_csv_excluding(spark, d)
    assert res.included == ["keep.csv"] and res.excluded == ["CLEANED_Canada_20240101.csv"]
    assert [r.x for r in res.frame.collect()] == ["1"]


def test_empty_guard_policies(spark):
    empty = spark.range(0)
    assert empty_guard(spark.range(3))[1] == "ok"
    assert empty_guard(empty, "skip") == (None, "skipped")
    assert empty_guard(empty, "stop") == (None, "stopped")
    with pytest.raises(EmptyInput):
        empty_guard(empty, "raise")


def test_write_csv_dated_round_trip(spark):
    df = spark.createDataFrame([("a b", 1.5), (None, 2.0)], "name string, v double")
    path = write_csv_dated(df, scratch_path(spark, "dated"), date=dt.date(2024, 3, 9))
    assert path.endswith("cleaned_canada_20240309.csv")
    back = read_csv_text(spark, path).select("name", F.col("v").cast("double"))
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_import_directory_isolates_failures(spark):
    d = scratch_path(spark, "imp")
    write_text(spark, f"{d}/good.csv", "id,flag,sold_date\n1,true,2024-01-01\n2,false,2024-01-02\n")
    write_text(spark, f"{d}/clash.csv", "id\nabc\n")
    write_text(spark, f"{d}/cleaned_canada.csv", "id\n9\n")
    db = "imp_zone_test"
    create_zone(spark, db, scratch_path(spark, db))
    # a pre-existing table whose type the file cannot satisfy makes one load fail
    spark.sql(f"CREATE TABLE {db}.clash (id int) USING parquet")
    report = {r.item: r for r in import_directory(spark, d, db).collect()}
    assert report["good.csv"].status == "loaded" and report["good.csv"].rows == 2
    assert report["clash.csv"].status == "failed"
    assert report["cleaned_canada.csv"].status == "excluded"
    types = dict(spark.table(f"{db}.good").dtypes)
    assert types == {"id": "bigint", "flag": "boolean", "sold_date": "date"}


def test_transfer_zone_skips_empty(spark):
    src, dst = "tz_src_test", "tz_dst_test"
    for db in (src, dst):
        create_zone(spark, db, scratch_path(spark, db))
    spark.createDataFrame([("1", "x")], "a string, b string").write.saveAsTable(f"{src}.t1")
    spark.createDataFrame([], "a string").write.saveAsTable(f"{src}.t0")
    assert [r.name for r in list_tables(spark, src).collect()] == ["t0", "t1"]
    report = {r.item: r.status for r in transfer_zone(spark, src, dst).collect()}
    assert report == {"t0": "skipped", "t1": "transferred"}
    assert dict(spark.table(f"{dst}.t1").dtypes) == {"a": "string", "b": "string"}   # typed source: text stays text


def test_fs_listing(spark):
    d = scratch_path(spark, "ls")
    write_text(spark, f"{d}/b.csv", "x\n")
    write_text(spark, f"{d}/a.csv", "x\n")
    assert [n for n, _ in fs.list_names(spark, d)] == ["a.csv", "b.csv"]
    assert CSV_OPTIONS["escape"] == '"'
