"""Intermediate tables go, vocabularies are measured before they are collected, fingerprints do not cancel out."""

import os

import pytest
from pyspark.sql import functions as F

from hausprep.operators import setops as S
from hausprep.operators import vocab as VO
from hausprep.plans.quality import quality_report
from hausprep.session import checkpoint_dir, materialize, scratch_path, scratch_scope


def left(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return set(os.listdir(base))


def test_scope_deletes_what_was_written_within(spark):
    before = left(spark)
    outer = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        materialize(spark.range(3), "gone")
        with scratch_scope(spark):
            materialize(spark.range(3), "inner")
        scratch_path(spark, "never_written")
        assert sum("gone-" in n for n in left(spark) - before) == 1 and not any("inner-" in n for n in left(spark) - before)
    assert [n.split("-")[0] for n in left(spark) - before] == ["kept"] and outer.count() == 3


def test_scope_deletes_after_a_failure(spark):
    before = left(spark)
    with pytest.raises(Exception, match="stop"):
        with scratch_scope(spark):
            materialize(spark.range(3), "gone")
            materialize(spark.range(3).select(F.raise_error(F.lit("stop"))), "failed")
    assert left(spark) == before


def test_quality_report_leaves_nothing(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("price"), F.lit(None).cast("string").alias("city"))
    before = left(spark)
    row = quality_report(df, ["price", "city"], "price").first()
    assert row["nulls_city"] == 100 and row["warning"] and left(spark) == before


def test_garage_vocabulary_in_one_scan(spark, tmp_path):
    rows = [("['Attached Garage', 'pool']", "['carport']"), (None, "['No Garage']"), ("['garage door']", None)]
    spark.createDataFrame(rows, "features string, parking string").write.parquet(f"file://{tmp_path}/t")
    terms = VO.garage_vocab(spark.read.parquet(f"file://{tmp_path}/t"), ["features", "parking"], ["garage", "car"], "No Garage")
    assert sorted(r[0] for r in terms.collect()) == ["attached garage", "carport", "garage door"]
    assert terms._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_large_terms_are_not_collected(spark, monkeypatch):
    """A few terms of many bytes go the way of a join."""
    monkeypatch.setattr(VO, "LITERAL_MAX_BYTES", 100)
    terms = spark.createDataFrame([("x" * 80,), ("y" * 80,), (None,)], "term string")
    assert VO.measured(terms)[1:] == (2, 160)
    df = spark.createDataFrame([(["x" * 80, "a"],), (["b"],), (None,)], "t array<string>")
    out = VO.flag_membership(df, {"hit": F.col("t")}, terms)
    assert sorted(r["hit"] for r in out.collect()) == [False, False, True]
    with pytest.raises(ValueError, match="too large"):
        VO.flag_membership(df, {"hit": F.col("t")}, terms, strategy="literal")


def test_rows_that_occur_twice_do_not_hide_differences(spark):
    once = spark.createDataFrame([(i, i % 7, i % 7, i % 5) for i in range(60)], "a int, b int, c int, d int")
    twice = once.unionByName(once)
    prints = twice.agg(*S.fingerprint_exprs(twice)).first()
    assert [prints[f"h{i}"] for i in range(4)] == [0, 0, 0, 0]
    assert len({(prints[f"h{i}"], prints[f"s{i}"]) for i in range(4)}) == 3          # only b and c agree
    assert S.duplicate_columns(twice) == ["c"]
