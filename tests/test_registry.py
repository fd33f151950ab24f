"""Every registered query against its DuckDB oracle on the sf0.001 tables,
plus plan checks."""

import contextlib
import hashlib
import io
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from hausprep import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_an_oracle():
    missing = set(registry.queries()) - set(entry.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "square_footage" in df.columns


def test_flagship_plan_has_no_python_and_one_scan(spark):
    df = entry.queries()["clean_listings"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("FileScan parquet") == 1   # one pass over the materialised rows


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_range_filter_pushed_to_parquet(spark):
    plan = _formatted(entry.queries()["range_filter"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_extendedprice,50000.0)" in plan
    assert "GreaterThan(l_quantity,12.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in plan
