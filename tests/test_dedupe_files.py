"""P3 on what it leaves on disk, on compressed files and on copied columns."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from hausprep.plans import zones
from hausprep.registry import queries
from hausprep.session import read_parquet_with, scratch_path
from hausprep.sources import files, fs

SF_SMALL = "/root/testdata/sf0.001"


def local(path):
    return path.removeprefix("file:")


def test_no_table_but_the_raw_and_the_clean_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z,x2,w\n" + "1,p,,1,\n2,q,5,2,\n1,p,,1,\n3,NA,6,3,7\n" * 2)
    (tmp_path / "b.csv").write_text("x,y,z,x2,w\n1,p,,1,\n4,q,5,4,9\n")
    work = scratch_path(spark, "w")
    out = zones.dedupe_files(spark, str(tmp_path), work)
    assert sorted(os.listdir(local(work))) == ["cleaned_data.parquet", "raw_data.parquet"]
    assert out.columns == ["x", "y", "z", "w"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("1", "p", None, None), ("2", "q", "5", None), ("3", None, "6", "7"), ("4", "q", "5", "9")], key=str)
    assert spark.read.parquet(f"{work}/raw_data.parquet").count() == 10


def test_columns_that_differ_in_one_row_of_many_copies_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z\n" + "1,1,1\n2,2,2\n" * 50 + "3,4,3\n")
    out = zones.dedupe_files(spark, str(tmp_path), scratch_path(spark, "w"))
    assert out.columns == ["x", "y"] and sorted(map(tuple, out.collect())) == [("1", "1"), ("2", "2"), ("3", "4")]


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n")
    assert zones.dedupe_files(spark, str(tmp_path), scratch_path(spark, "w")).count() == 0


def test_the_query_keeps_its_csv_files_compressed(spark, monkeypatch):
    seen = []
    whole = zones.dedupe_files

    def spied(spark, source, work, **options):
        seen.extend((source, name) for name, _ in fs.list_names(spark, source))
        return whole(spark, source, work, **options)

    monkeypatch.setattr("hausprep.registry.io_queries.dedupe_files", spied)
    out = queries()["dedupe_files"](spark, SF_SMALL)
    text = out.select(F.sum(F.octet_length(F.concat_ws(",", *out.columns)))).first()[0]
    assert [name for _, name in seen] == ["listings_monday.csv", "listings_tuesday.csv"]
    for source, name in seen:
        assert sum(fs.sizes(spark, f"{source}/{name}")) < text / 2
        assert files.read_csv_text(spark, f"{source}/{name}").count() >= out.count()


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_compressed_files_are_read_as_others(spark, tmp_path, split):
    text = "a,b\n" + "".join(f'{i},"x\n{i}"\n' for i in range(500))
    (tmp_path / "plain.csv").write_text(text)
    (tmp_path / "packed.csv").mkdir()
    for part in range(2):
        with gzip.open(tmp_path / "packed.csv" / f"part-{part}.csv.gz", "wt") as f:
            f.write(text)
    assert fs.split_sizes(spark, str(tmp_path / "packed.csv")) == [] and fs.split_sizes(spark, str(tmp_path / "plain.csv")) == [len(text)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = files.scan_csv_dir(spark, str(tmp_path)).groupBy("a", "b").pivot("source", ["plain.csv", "packed.csv"]).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 500 and {tuple(r)[2:] for r in found} == {(1, 2)}
    assert {(r["a"], r["b"]) for r in found} == {(str(i), f"x\n{i}") for i in range(500)}


def test_a_task_gets_a_bounded_part_of_the_text(spark, monkeypatch):
    rows = spark.range(200_000).select(*[F.concat(F.lit("value "), (F.col("id") % n).cast("string")).alias(f"c{n}") for n in (3, 5, 7, 199_999)])
    path = scratch_path(spark, "raw")
    rows.coalesce(1).write.options(**zones.RAW_OPTIONS | {"parquet.block.size": "100000"}).parquet(path)
    text = rows.agg(F.sum(F.octet_length(F.concat(*rows.columns)))).first()[0]
    before = spark.conf.getAll
    monkeypatch.setattr(zones, "TASK_TEXT", text // 20)
    monkeypatch.setattr(zones, "LEAST_SPLIT", 1000)
    small = zones._read_in_small_tasks(spark, path, text)
    sizes = [r["n"] for r in small.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= 10 and max(sizes) <= 20_000
    assert spark.conf.getAll == before


def test_settings_of_one_job(spark):
    path = scratch_path(spark, "p")
    spark.range(10).write.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = read_parquet_with(spark, path, {"spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.enabled": "false"})
    assert df.groupBy("id").count().rdd.getNumPartitions() == 3 and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.sparkContext.parallelize([(1,)]).toDF(["a"]).sparkSession is spark
