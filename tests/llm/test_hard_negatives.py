"""Hard negatives against every pair of rows and their SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hausprep.llm import hard_negatives as hn
from hausprep.llm import queries

SF = "/root/testdata/sf0.01"


def brute(rows, anchor, positives=5, negatives=3, scale=256):
    """Rows of ``hard_negatives`` for distinct ids, every anchor with every row."""
    def fits(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[1])
    quantised = [(i, [math.floor(scale * float(x)) for x in v], label) for i, v, label in filter(fits, rows)]
    out = []
    for i, v, label in quantised:
        if not anchor(i):
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in quantised if j != i]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:positives]:
            near = sorted(x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(near)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("scale", [256, 3, 1 << 26, 1 << 29])      # few distinct scores; whole numbers beyond exact doubles
def test_against_every_pair(spark, scale, monkeypatch):
    rnd = random.Random(scale)
    rows = [(i, [rnd.uniform(-1, 1) * rnd.choice([0.1, 1, 1]) for _ in range(19)], rnd.choice([0, 0, 0, 1, 2])) for i in range(300)]
    rows += [(i, rows[i % 40][1], rnd.choice([1, 2])) for i in range(300, 360)]           # ties
    rows += [(400, None, 1), (401, [1.0] * 18 + [None], 1), (402, [float("nan")] * 19, 0), (403, [float("inf")] * 19, 0),
             (405, [0.5] * 19, None), (None, [0.5] * 19, 1), (410, [0.0] * 19, 2), (415, [0.9] * 19, 7), (420, [0.2] * 4, 0), (425, [], 1)]
    if scale == 256:
        monkeypatch.setattr(hn, "ROW_BLOCK", 50)
        monkeypatch.setattr(hn, "ANCHOR_BLOCK", 7)
    got = result(hn.hard_negatives(frame(spark, rows + rows[:90]), F.col("id") % 5 == 0, scale=scale))
    assert got == brute(rows, lambda i: i % 5 == 0, scale=scale) and got


def test_scan_drops_rows_before_the_last_dimension():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-100, 100, (4000, 32))
    anchor = rng.permutation((1000 * 0.7 ** np.arange(32)).astype(np.int64)) * rng.choice([-1, 1], 32)
    columns, seen = hn.Columns(vectors, 1000), []

    def counted(useful):
        def f(low, high):
            seen.append(len(low))
            return useful(low, high)
        return f
    rows, scores = columns.scan(anchor, np.arange(4000), counted(hn.best_rows(5)))
    exact = vectors @ anchor
    assert set(np.argsort(-exact)[:5]) <= set(rows.tolist()) and (exact[rows] == scores).all()
    assert seen[0] == 4000 and seen[1] < 400
    low, high = int(np.sort(exact)[-400]), int(np.sort(exact)[-300])
    rows, scores = columns.scan(anchor, np.arange(4000), hn.window_rows([(low, high)], 3))
    assert sorted(exact[(exact >= low) & (exact <= high)])[-3:] == sorted(s for s in scores if low <= s <= high)[-3:]


def test_rows_of_one_id(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [0.0, 1.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [0.75, 0.75], 2)]
    got = result(hn.hard_negatives(frame(spark, rows), F.col("id") == 0))
    assert got == [(0, 1, 1, 2, 65536, 49152)] * 2          # the other row of id 0 scores zero: no window
    assert result(hn.hard_negatives(frame(spark, rows).limit(0), F.col("id") == 0)) == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = result(queries.op13_hard_negatives(spark, SF))
    assert got == sorted(con.execute(hn.ORACLE_SQL).fetchall()) and got
