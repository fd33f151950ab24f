"""Profiling and aggregation operators (A1-A12) and top-k (K1, K2).

Multi-column results use a long layout (one row per column) so that every
profile is a plain frame, whatever the width of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.common import qcol
from hausprep.operators.quantiles import quantile_frame


def _missing(df: DataFrame, name: str) -> Column:
    c = qcol(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _unpivot_one_row(agg_row_df: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate with fields ``{field}{i}`` into rows
    ``(column_name, field...)``."""
    return agg_row_df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}{i}").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ])).alias("s")).select("s.*")


# ---- A1 / A12 ---------------------------------------------------------------

def row_count(df: DataFrame) -> DataFrame:
    """A1: number of rows (and columns) of a frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def rows_per_source(df: DataFrame, source: str = "source") -> DataFrame:
    """Rows per input source (one job for all sources)."""
    return df.groupBy(qcol(source).alias(source)).agg(F.count(F.lit(1)).alias("rows"))


# ---- A2 / A3 / A4 / K1 --------------------------------------------------------

def value_counts(df: DataFrame, column: str, *, dropna: bool = True) -> DataFrame:
    """A2: rows per value, most frequent first (ties by value); missing
    values excluded unless ``dropna=False``."""
    src = df.where(~_missing(df, column)) if dropna else df
    return (src.groupBy(qcol(column).alias(column)).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last(qcol(column))))


def value_counts_multi(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A3: rows per combination of values; rows with any missing excluded."""
    return (df.na.drop(how="any", subset=list(columns))
            .groupBy(*[qcol(c).alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("count")))


def aligned_counts(df: DataFrame, a: str, b: str, *, value: str = "value") -> DataFrame:
    """A4: counts of two columns side by side over the union of their values
    (absent -> 0).  One scan and one shuffle: both columns are unpivoted
    into ``(value, source)`` and counted together, no join."""
    dt = df.schema[a].dataType
    same = dt == df.schema[b].dataType
    ca = qcol(a) if same else qcol(a).cast("string")
    cb = qcol(b) if same else qcol(b).cast("string")
    pairs = df.select(F.explode(F.array(
        F.struct(ca.alias("v"), F.lit(0).alias("src")),
        F.struct(cb.alias("v"), F.lit(1).alias("src")),
    )).alias("s")).select("s.v", "s.src").where(F.col("v").isNotNull())
    return pairs.groupBy(F.col("v").alias(value)).agg(
        F.count_if(F.col("src") == 0).alias(f"{a}_count"),
        F.count_if(F.col("src") == 1).alias(f"{b}_count"),
    )


def top_k_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """K1: the ``k`` most frequent values (ties broken by value)."""
    return value_counts(df, column).limit(k)


def head(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """K2: first ``n`` rows in a deterministic order (all columns by default)."""
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.asc_nulls_first(qcol(c)) for c in keys]).limit(n)


# ---- A5 / A6 / A9 -------------------------------------------------------------

def n_distinct(df: DataFrame, columns: Sequence[str], *, approx: bool = False,
               rsd: float = 0.01) -> DataFrame:
    """A5: distinct values per column, a missing value counting as one
    value; rows ``(column_name, n_distinct)``.  ``approx=True`` uses
    HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``):
    constant memory per column and no per-column expansion of the rows."""
    def distinct(c):
        return F.approx_count_distinct(qcol(c), rsd) if approx else F.count_distinct(qcol(c))
    aggs = [(distinct(c) + F.max(F.when(_missing(df, c), 1).otherwise(0)))
            .cast("bigint").alias(f"n_distinct{i}") for i, c in enumerate(columns)]
    return _unpivot_one_row(df.agg(*aggs), columns, ["n_distinct"])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column; rows ``(column_name, nulls)``."""
    cols = list(columns) if columns is not None else df.columns
    aggs = [F.count_if(_missing(df, c)).alias(f"nulls{i}") for i, c in enumerate(cols)]
    return _unpivot_one_row(df.agg(*aggs), cols, ["nulls"])


def schema_info(df: DataFrame, *, with_rows: bool = False) -> DataFrame:
    """``(ordinal, column_name, non_null, data_type)`` per column, from
    one aggregate (``with_rows`` adds the table's row count)."""
    cols = df.columns
    aggs = [F.count_if(~_missing(df, c)).alias(f"non_null{i}") for i, c in enumerate(cols)]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    extra = [F.col("__rows").alias("rows")] if with_rows else []
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                 F.col(f"non_null{i}").alias("non_null"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("data_type"), *extra)
        for i, c in enumerate(cols)
    ])).alias("s")).select("s.*")


# ---- A7 / A8 / A10 / A11 ------------------------------------------------------

def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact 25/50/75 % (linear
    interpolation) and max per numeric column, missing values ignored."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.when(~_missing(df, c), qcol(c).cast("double"))
        aggs += [F.count(v).alias(f"count{i}"), F.avg(v).alias(f"mean{i}"),
                 F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"min{i}"),
                 F.max(v).alias(f"max{i}")]
    stats = _unpivot_one_row(df.agg(*aggs), columns, ["count", "mean", "std", "min", "max"])
    quarts = quantile_frame(df, columns, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
    return stats.join(quarts, "column_name").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _as_text(df: DataFrame, name: str) -> Column:
    """A column's values as text for grouping across columns; -0.0 and 0.0
    (equal numbers) get one spelling, NaN is missing."""
    c = qcol(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        c = F.when(F.isnan(c), F.lit(None)).when(c == 0, F.lit(0.0)).otherwise(c)
    return c.cast("string")


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value, freq`` of all present values, as text: one unpivot and a partial aggregate."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _as_text(df, c).alias("value"))
        for c in columns])).alias("s")).select("s.*").where(F.col("value").isNotNull())
    return stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("freq"))


def summarise_frequencies(freq: DataFrame) -> DataFrame:
    """A8 from :func:`value_frequencies`."""
    return freq.groupBy("column_name").agg(
        F.sum("freq").cast("bigint").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by(F.col("value"), F.struct((-F.col("freq")).alias("nf"), F.col("value"))).alias("top"),
        F.max("freq").alias("freq"),
    )


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, number of distinct values, most frequent value (ties: the
    smallest) and its frequency, per column, missing values excluded.

    One unpivot and two partial aggregates: no group is ever gathered, a
    value filling a third of the rows is a single counter."""
    return summarise_frequencies(value_frequencies(df, columns))


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float] = (0.25, 0.75), *,
              names: Sequence[str] | None = None) -> DataFrame:
    """A10: exact quantiles (linear interpolation) of one column."""
    return quantile_frame(df, [column], probabilities, names=names).drop("column_name")


def iqr_bounds(df: DataFrame, column: str, *, factor: float = 1.5) -> DataFrame:
    """One row: q1, q3, iqr and the lower/upper fences."""
    q = quantiles(df, column, [0.25, 0.75], names=["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - F.lit(factor) * iqr).alias("lower"),
                    (F.col("q3") + F.lit(factor) * iqr).alias("upper"))


def iqr_fences(df: DataFrame, column: str, *, factor: float = 1.5) -> dict[str, float | None]:
    """The one-row result of :func:`iqr_bounds` as numbers (five values reach
    the driver, whatever the size of the column)."""
    row = iqr_bounds(df, column, factor=factor).first()
    return row.asDict() if row else {k: None for k in ("q1", "q3", "iqr", "lower", "upper")}


def _outside(column: str, fences: dict) -> Column:
    v = qcol(column)
    if fences["lower"] is None:
        return F.lit(False)
    return (v < F.lit(fences["lower"])) | (v > F.lit(fences["upper"]))


def iqr_outlier_rows(df: DataFrame, column: str, *, factor: float = 1.5) -> DataFrame:
    """Rows outside the fences (strictly below or above)."""
    return df.where(_outside(column, iqr_fences(df, column, factor=factor)))


def iqr_outliers(df: DataFrame, column: str, *, factor: float = 1.5) -> DataFrame:
    """Fences and the number of rows outside them (one row)."""
    f = iqr_fences(df, column, factor=factor)
    return df.agg(F.count_if(_outside(column, f)).alias("outliers")).select(
        *[F.lit(f[k]).cast("double").alias(k) for k in ("q1", "q3", "iqr", "lower", "upper")], "outliers")
