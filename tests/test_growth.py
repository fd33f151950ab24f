"""Steps whose cost must not outgrow their input: duplicate rows, stage counts, CSV records, profiles, token keys."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hausprep.functions import tokens as TK
from hausprep.operators import setops as S
from hausprep.plans import listings as L
from hausprep.plans import quality as Q
from hausprep.plans.listings import clean_listings
from hausprep.registry.fixtures import VIEW_COLUMNS, VIEW_OUTPUT, listing_raw_frames
from hausprep.sources import records as R

SF_SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_cells_move_as_one_key(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, x string, y string, z string")
    exchange = next(line for line in plan(S.distinct_rows(df, packed=True)).splitlines() if "Exchange hashpartitioning" in line)
    assert "row#" in exchange and "x#" not in exchange and "z#" not in exchange


def test_packed_rows_are_exact(spark):
    cells = [None, "", "\x1d", "\x1e", "\x1f", "\x1d0", "\x1d1", "a\x1fb", "é"]
    rows = [(x, y, "z", 1.5) for x in cells for y in cells] * 2
    df = spark.createDataFrame(rows, "x string, y string, z string, n double")
    df = df.unionByName(spark.sql("SELECT cast(x'ff41fe' AS string) AS x, 'y' AS y, cast(x'80' AS string) AS z, 2D AS n"))
    shown = lambda d: sorted(map(str, d.select(*[F.hex(c).alias(c) for c in "xyz"], "n").collect()))
    assert shown(S.distinct_rows(df, packed=True)) == shown(df.dropDuplicates()) and S.distinct_rows(df, packed=True).count() == 82


def test_spellings_are_merged_only_where_there_are_any(spark, monkeypatch):
    frames = listing_raw_frames(spark, SF_SMALL)
    expected = clean_listings(frames, VIEW_COLUMNS, VIEW_OUTPUT).count()
    other = [frames[0], frames[1].withColumn("beds", F.concat("beds", F.lit(".0")))]
    assert clean_listings(other, VIEW_COLUMNS, VIEW_OUTPUT).count() == expected
    monkeypatch.setattr(L, "merge_spellings", lambda *a: pytest.fail("a second pass without need"))
    assert clean_listings(frames, VIEW_COLUMNS, VIEW_OUTPUT).count() == expected


def test_stage_metrics_write_the_rows_once(spark, monkeypatch):
    monkeypatch.setattr(Q, "materialize", lambda *a, **k: pytest.fail("a second table"))
    frames = [f.withColumn("source", F.lit(s)) for f, s in zip(listing_raw_frames(spark, SF_SMALL), ("a", None))]
    found = {r["stage"]: r["rows"] for r in Q.stage_metrics(frames, VIEW_COLUMNS, VIEW_OUTPUT, source_column="source").collect()}
    assert found["raw"] == 2 * found["raw:a"] == 2 * found["raw:"] and found["after_dedup"] <= found["raw:a"]


def test_profile_is_worked_out_once(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("double").alias("n"), F.col("id").cast("string").alias("t"))
    profile = Q.profile_table(df)
    assert "Range" not in plan(profile) and profile.where("column_name = 'n'").first()["n_distinct"] == 7


def test_regular_lines_are_found_in_batches():
    rng = random.Random(5)
    lines = ["".join(rng.choice('",,ab\r﻿') for _ in range(rng.randint(0, 9))) for _ in range(20_000)]
    irregular = set(R._irregular(pa.array(lines)))
    regular = [line for i, line in enumerate(lines) if i not in irregular]
    assert len(regular) > 2000 and any('"' in line for line in regular)
    assert not any(R.ends_inside(line, False) for line in regular)
    assert R._cell_counts(pa.array(regular)).to_pylist() == [R.cells_of(line) for line in regular]


def test_labels_by_token_lookup(spark):
    """The same labels as by a search for each term, without any such search."""
    rng = random.Random(6)
    cells = [", ".join(rng.choice(["a", "b", "c c", "", "d", "zz"]) for _ in range(rng.randint(0, 4))) for _ in range(300)] + [None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    words = [("one", ["d", "c c"]), ("none", []), ("two", ["a", "d"]), ("three", ["", "b,zz"])]
    tokens = TK.tokens_match("c")
    by_key = TK.classify_first(None, words, tokens=tokens, key=TK.token_key(tokens))
    out = df.select(TK.classify_first("c", words).alias("k"), by_key.alias("e"))
    assert out.where(~F.col("k").eqNullSafe(F.col("e"))).count() == 0 and out.select("k").distinct().count() == 4
    assert "Contains" not in plan(out.select("k")) and "contains" not in plan(df.select(TK.classify_first("c", words))).lower()
