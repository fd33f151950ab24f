"""Input as it really comes: missing-value markers, copied and empty columns, odd names, ragged zones."""

import pytest
from pyspark.sql import functions as F

from hausprep.functions.tokens import has_any, token_key
from hausprep.operators import setops as S
from hausprep.operators.vocab import flag_membership
from hausprep.plans import zones
from hausprep.plans.listings import ListingColumns, clean_listings
from hausprep.plans.quality import quality_report
from hausprep.session import scratch_path
from hausprep.sources import catalog, files, fs


def write_text(path, text):
    path.mkdir(exist_ok=True) if path.suffix == "" else path.write_text(text)


def test_default_columns_with_copied_and_empty_unused_columns(spark):
    cols = ListingColumns()
    names = [*dict.fromkeys([*cols.roles().values(), *cols.unused]), "__extra"]
    row = {n: None for n in names}
    row |= {cols.street_address: "1 Main", cols.locality: "A", cols.region: "AB", cols.price: "100000", cols.beds: "3",
            cols.baths: "2", cols.sqft: "1,200 SQFT", "Bath": "2", "__extra": "kept", cols.latitude: "1", cols.longitude: "2"}
    df = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"`{n}` string" for n in names))
    out = clean_listings(df)
    assert out.count() == 1 and "__extra" in out.columns
    assert clean_listings(df.limit(0)).count() == 0


def test_import_makes_markers_null_and_reports_clashes(spark, tmp_path):
    for name, text in (("n.csv", "a,b\n1,x\nNA,y\n3,z\n"), ("x-1.csv", "a\n1\n"), ("x 1.csv", "a\n2\n"), ("_u.csv", "a\n1\n")):
        (tmp_path / name).write_text(text)
    db = f"real_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'db')}'")
    report = {r["item"]: r for r in zones.import_directory(spark, str(tmp_path), db).collect()}
    assert dict(spark.table(f"{db}.n").dtypes)["a"] == "double"
    assert spark.table(f"{db}.n").where("a is null").count() == 1
    assert {report[n]["status"] for n in ("x-1.csv", "x 1.csv", "_u.csv")} == {"failed"}
    assert "table name x_1" in report["x-1.csv"]["message"] and "rename" in report["_u.csv"]["message"]


def test_dedupe_files_with_markers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("a,b\n1,NA\n1,\n2,x\n")
    assert zones.dedupe_files(spark, str(tmp_path / "in"), scratch_path(spark, "w"), multi_line=False).count() == 2


def test_transfer_keeps_text(spark, tmp_path):
    src, dst = (f"{k}_{abs(hash(str(tmp_path)))}" for k in ("src", "dst"))
    for db in (src, dst):
        spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    spark.createDataFrame([("007", "2024-01-02")], "code string, sold_date string").write.saveAsTable(f"{src}.t")
    zones.transfer_zone(spark, src, dst)
    assert spark.table(f"{dst}.t").select("code").first()[0] == "007"
    assert dict(spark.table(f"{dst}.t").dtypes)["sold_date"] == "date"


def test_append_load_raises_on_extra_and_fills_missing(spark, tmp_path):
    db = f"app_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    spark.sql(f"CREATE TABLE {db}.t (a int, b string) USING parquet")
    with pytest.raises(ValueError, match="extra|columns"):
        catalog.append_load(spark.sql("select 1 a, 'x' b, 'lost' c"), "t", db)
    assert catalog.append_load(spark.sql("select 1 a"), "t", db) == 1
    assert spark.table(f"{db}.t").first()["b"] is None


def test_failed_and_repeated_loads_leave_each_row_once(spark, tmp_path, monkeypatch):
    db = f"once_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, db)}'")
    spark.sql(f"CREATE TABLE {db}.t (a bigint, b string) USING parquet")
    rows = spark.range(100).repartition(4).withColumn("b", F.col("id").cast("string")).withColumnRenamed("id", "a")
    table = lambda: sorted(r.a for r in spark.table(f"{db}.t").collect())
    failing = rows.withColumn("a", F.when(F.col("a") == 99, F.raise_error(F.lit("stop"))).otherwise(F.col("a")))
    with pytest.raises(Exception, match="stop"):                     # fails while staging: nothing is seen
        catalog.append_load(failing, "t", db, run_id="r1")
    assert table() == []
    rename, moves = fs.rename, []

    def stops_at_third(spark, src, dst):
        moves.append(src)
        if len(moves) == 3:
            raise OSError("lost")
        rename(spark, src, dst)
    monkeypatch.setattr(fs, "rename", stops_at_third)
    with pytest.raises(OSError):                                     # fails between two moves
        catalog.append_load(rows, "t", db, run_id="r1")
    monkeypatch.setattr(fs, "rename", rename)
    assert catalog.append_load(rows, "t", db, run_id="r1") == 100
    assert catalog.append_load(rows, "t", db, run_id="r1") == 0
    assert table() == list(range(100))
    assert catalog.append_load(rows, "t", db, run_id="r2") == 100 and catalog.append_load(rows, "t", db) == 100
    assert table() == sorted([*range(100)] * 3)
    with pytest.raises(ValueError, match="run id"):
        catalog.append_load(rows, "t", db, run_id="../x")


@pytest.mark.parametrize("n", [1, 64, 65, 101])
def test_terms_with_commas_are_the_same_at_every_size(spark, n):
    df = spark.createDataFrame([(["a,b", "c"],), ([None, "z"],), (None,)], "t array<string>")
    terms = ["a,b"] + [f"x{i}" for i in range(n - 1)]
    assert [r[0] for r in df.select(has_any(F.col("t"), terms)).collect()] == [True, False, False]
    assert [r[0] for r in df.select(has_any(F.col("t"), ["b"])).collect()] == [False, False, False]
    vocabulary = spark.createDataFrame([(t,) for t in terms], "term string")
    for strategy in ("literal", "broadcast", "shuffle"):
        out = flag_membership(df, {"hit": F.col("t")}, vocabulary, strategy=strategy)
        assert sorted(r["hit"] for r in out.collect()) == [False, False, True]


def test_key_search_agrees_for_tokens_without_commas(spark):
    df = spark.createDataFrame([(["car", "pool"],), ([],), (None,)], "t array<string>")
    for terms in (["pool"], ["car", "x"], ["ool"]):
        both = df.select(has_any(F.col("t"), terms), has_any(F.col("t"), terms, key=token_key(F.col("t")))).collect()
        assert all(a == b for a, b in both)


def test_many_equal_columns_take_one_check_each(spark):
    df = spark.range(10).select("id", *[F.lit(None).cast("string").alias(f"c{i}") for i in range(120)])
    assert S.distinct_columns(df).columns == ["id", "c0"]


def test_quality_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "price double")
    assert quality_report(df, ["price"], "price").first()["nulls_price"] == 2


def test_jdbc_failure_is_not_an_empty_table(spark):
    with pytest.raises(Exception):
        catalog.scan_jdbc_or_empty(spark, "jdbc:nosuchdriver://localhost/x", "t", {"driver": "no.such.Driver"})
    assert catalog._MISSING_TABLE.search('relation "t" does not exist')
    assert not catalog._MISSING_TABLE.search("password authentication failed")


def test_hidden_file_names_are_not_lost_silently(spark, tmp_path):
    (tmp_path / "_x.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="rename"):
        files.scan_csv_dir(spark, str(tmp_path))
