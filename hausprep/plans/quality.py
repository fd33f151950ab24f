"""Run-time checks and metrics: P6 ``quality_report``, P7 ``stage_metrics``,
P8 ``profile_table``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.common import qcol
from hausprep.operators.filters import drop_incomplete
from hausprep.operators.profile import (
    _missing,
    describe_numeric,
    iqr_fences,
    schema_info,
    summarise_frequencies,
    value_frequencies,
)
from hausprep.operators.setops import canonical_numbers, distinct_columns, distinct_rows, fingerprint_exprs
from hausprep.plans.listings import (
    ListingColumns,
    ListingOutput,
    clean_stage,
    consistency_stage,
    finalize_stage,
    load_stage,
    numeric_text,
)
from hausprep.session import materialize, materialize_observed, scratch_scope


def quality_report(df: DataFrame, critical: Sequence[str], value: str, *, factor: float = 1.5) -> DataFrame:
    """One row - missing values per critical column, IQR fences of
    ``value``, the number of rows outside them, and a warning flag.
    Warnings are data, the run always continues."""
    # A few passes read these few columns; what made them runs once, and the table goes at the end.
    spark = df.sparkSession
    with scratch_scope(spark):
        df = materialize(df.select(*[qcol(c) for c in dict.fromkeys([*critical, value])]), "quality")
        nulls = [F.count_if(_missing(df, c)).alias(f"nulls_{c}") for c in critical]
        f = iqr_fences(df, value, factor=factor)
        outside = F.lit(False) if f["lower"] is None else (
            (qcol(value) < F.lit(f["lower"])) | (qcol(value) > F.lit(f["upper"])))
        row = df.agg(*nulls, F.count_if(outside).alias("outliers"))
        any_null = F.lit(False)
        for c in critical:
            any_null = any_null | (qcol(f"nulls_{c}") > 0)
        report = row.select(
            *[qcol(f"nulls_{c}") for c in critical],
            *[F.lit(f[k]).cast("double").alias(k) for k in ("q1", "q3", "lower", "upper")], "outliers",
            (any_null | (F.col("outliers") > 0)).alias("warning"),
        )
        return spark.createDataFrame(report.collect(), report.schema)


def stage_metrics(frames, cols: ListingColumns = ListingColumns(),
                  out: ListingOutput = ListingOutput(), *, source_column: str | None = None) -> DataFrame:
    """Rows at each stage of the listing cleaner - raw (and ``raw:<source>``
    per source when a source column exists), after duplicate removal, after
    dropping rows without address/price, final - and ``nulls:<column>`` for
    every final column.  Frame ``(stage, rows)``.

    The source is no part of a row's identity: the same listing in two
    sources is one row, so the deduplicated rows are shuffled and written once, without it;
    their number and U3's fingerprints are observed in that write, a result stage, so the values
    are exact even when tasks are retried.  Rows per source are a count of that column alone, a second
    look at the raw input that moves no rows.  The few rows are
    worked out at once, and the intermediate tables deleted."""
    spark = (frames if isinstance(frames, DataFrame) else frames[0]).sparkSession
    with scratch_scope(spark):
        result = _stage_metrics(frames, cols, out, source_column)
        return spark.createDataFrame(result.collect(), result.schema)


def _stage_metrics(frames, cols: ListingColumns, out: ListingOutput, source_column: str | None) -> DataFrame:
    raw = load_stage(frames)
    by_source = source_column is not None and source_column in raw.columns
    raw = canonical_numbers(raw, numeric_text(raw, cols))
    keys = distinct_rows(raw.drop(source_column) if by_source else raw, packed=True)
    deduped, metrics = materialize_observed(
        keys, [*fingerprint_exprs(keys), F.count(F.lit(1)).alias("__dedup_rows")], "stage_metrics")
    # Rows per source and in all: one count, of which only the source column is read.
    sources = qcol(source_column).cast("string") if by_source else F.lit(None).cast("string")
    loaded = [(s, n) for s, n in raw.groupBy(sources.alias("source")).agg(F.count(F.lit(1))).collect()]
    present = [c for c in [*cols.roles().values(), *cols.unused] if c in deduped.columns]
    complete = drop_incomplete(distinct_columns(deduped, protect=present, fingerprints=metrics),
                               cols.required_for_address())
    final = consistency_stage(finalize_stage(clean_stage(complete, cols, out), cols, out, raw_columns=complete.columns), out)

    def counts(df: DataFrame, *stages) -> DataFrame:
        """One aggregate for ``(stage, count)`` pairs, a row each."""
        one = df.agg(*[value.cast("bigint").alias(f"n{i}") for i, (_, value) in enumerate(stages)])
        return one.select(F.explode(F.array(*[
            F.struct(F.lit(stage).alias("stage"), F.col(f"n{i}").alias("rows")) for i, (stage, _) in enumerate(stages)
        ])).alias("s")).select("s.*")

    every = F.count(F.lit(1))
    observed = deduped.sparkSession.createDataFrame(
        [("raw", sum(n for _, n in loaded)), ("after_dedup", int(metrics["__dedup_rows"])),
         *([(f"raw:{s or ''}", n) for s, n in loaded] if by_source else [])],
        "stage string, rows bigint")
    result = observed.unionByName(counts(complete, ("after_dropna", every))).unionByName(
        counts(final, ("final", every), *[(f"nulls:{c}", F.count_if(_missing(final, c))) for c in final.columns]))
    return result


def profile_table(df: DataFrame, columns: Sequence[str] | None = None, *, top_n: int = 5) -> DataFrame:
    """One row per column - type, non-null and missing counts, distinct values (missing counted
    once), the most frequent value and its count (A8), the ``top_n`` most frequent values with their
    counts (A2, ties: the smallest value first), and for numeric columns mean, sample standard deviation,
    minimum, quartiles and maximum (A7), null for others.

    The grouped ``(column, value)`` counts are made once and give distinct values, top and top-N (so no
    per-column ``count(DISTINCT)`` expansion, and no column's values are sorted: a task passes on
    its ``top_n`` best of each column); counts of all columns are one aggregate, and A7's another
    with its brackets.  These passes read the columns as written once, so what made them runs once;
    the few rows are worked out at once, and the table goes at the end."""
    cols = list(columns) if columns is not None else df.columns
    spark = df.sparkSession
    with scratch_scope(spark):
        result = _profile(materialize(df.select(*[qcol(c) for c in cols]), "profile"), cols, top_n)
        return spark.createDataFrame(result.collect(), result.schema)


def _profile(df: DataFrame, cols: Sequence[str], top_n: int) -> DataFrame:
    info = schema_info(df, with_rows=True)
    counts = value_frequencies(df, cols)
    best = Window.partitionBy("column_name").orderBy(F.desc("freq"), "value")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_n).groupBy("column_name").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "value", "freq"))),
                    lambda s: F.struct(s["value"].alias("value"), s["freq"].alias("freq"))).alias("top_values"))
    cat = summarise_frequencies(counts)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    if numeric:
        described = describe_numeric(df, numeric).select("column_name", *stats)
    else:
        described = df.sparkSession.createDataFrame([], ", ".join(["column_name string", *[f"{c} double" for c in stats]]))
    nulls = (F.col("rows") - F.col("non_null")).alias("nulls")
    return (info.join(cat.select("column_name", "unique", "top", "freq"), "column_name", "left")
            .join(top, "column_name", "left").join(described, "column_name", "left")
            .select("ordinal", "column_name", "data_type", "non_null", nulls,
                    (F.coalesce(F.col("unique"), F.lit(0))
                     + F.when(F.col("rows") > F.col("non_null"), 1).otherwise(0)).cast("bigint").alias("n_distinct"),
                    "top", "freq", "top_values", *stats))
