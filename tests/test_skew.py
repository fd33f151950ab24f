"""A key, source or group of copies holding a third of all rows."""

import contextlib
import io

from pyspark.sql import functions as F

from hausprep.operators import profile as P
from hausprep.operators import setops as S


def _hot_frame(spark, n=30_000):
    # a third of the rows are one and the same row; spread over many partitions
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 7).alias("v"))
    return base.repartition(16)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_hot_duplicate_collapses_before_the_shuffle(spark):
    df = _hot_frame(spark)
    out = S.distinct_rows(df)
    assert out.count() == 20_001
    plan = _plan(out)
    # partial aggregate (map side) -> Exchange -> final aggregate
    tree = plan.split("\n\n", 1)[0]
    assert tree.count("HashAggregate") == 2 and "Exchange" in tree
    # the second aggregate sits below the exchange: duplicates merge map-side
    assert tree.index("Exchange") < tree.rindex("HashAggregate")


def test_hot_key_value_counts(spark):
    df = _hot_frame(spark)
    top = P.top_k_values(df, "k", 1).first()
    assert top.k == "hot" and top["count"] == 10_000
    plan = _plan(P.value_counts(df, "k"))
    assert "partial_count" in plan


def test_hot_value_quantiles_exact(spark):
    df = _hot_frame(spark)
    q = P.quantiles(df, "v", [0.1, 0.5, 0.9], names=["a", "b", "c"]).first()
    vals = sorted(r.v for r in df.select("v").collect())
    import numpy as np
    assert (q.a, q.b, q.c) == tuple(float(np.percentile(vals, p)) for p in (10, 50, 90))
