"""Projection, filter, predicate and cast operators (F1-F8)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.common import qcol
from hausprep.operators.schema import as_double


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows with any missing value (null, or NaN in a float column)
    among ``subset``.  Written as plain ``IS NOT NULL`` predicates (rather
    than ``na.drop``) so that they reach a Parquet scan as pushed filters."""
    cond = F.lit(True)
    for name in subset:
        c = qcol(name)
        present = c.isNotNull()
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            present = present & ~F.isnan(c)
        cond = cond & present
    return df.filter(cond)


def range_filter(
    df: DataFrame,
    column: str,
    *,
    lower: float | None = None,
    lower_inclusive: bool = True,
    upper: float | None = None,
    upper_inclusive: bool = True,
) -> DataFrame:
    """keep rows inside a (half-)open range.  On a Parquet column the
    comparison is pushed into the scan."""
    c = qcol(column)
    cond = F.lit(True)
    if lower is not None:
        cond = cond & ((c >= lower) if lower_inclusive else (c > lower))
    if upper is not None:
        cond = cond & ((c <= upper) if upper_inclusive else (c < upper))
    return df.filter(cond)


def eq_filter_project(df: DataFrame, column: str, value, columns: Sequence[str]) -> DataFrame:
    """rows with ``column == value``, restricted to ``columns``."""
    return df.filter(qcol(column) == F.lit(value)).select(*[qcol(c) for c in columns])


def drop_columns(df: DataFrame, names: Iterable[str], *, strict: bool = True) -> DataFrame:
    """drop named columns.  Unlike ``DataFrame.drop``, an unknown name is
    an error unless ``strict=False``."""
    names = list(names)
    if strict:
        missing = [n for n in names if n not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    gone = set(names)
    return df.select(*[qcol(c) for c in df.columns if c not in gone])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """rename columns (unknown source names are ignored, as in Spark)."""
    return df.withColumnsRenamed(dict(mapping))


def to_double(c: Column, *, strip: str | None = None, mode: str = "strict", label: str = "") -> Column:
    """Text -> double.  ``strict`` raises on a malformed value whatever the
    session's ANSI setting; ``null`` turns it into a missing value."""
    src = F.replace(c, F.lit(strip), F.lit("")) if strip else c
    parsed = as_double(src)
    if mode == "null":
        return parsed
    if mode != "strict":
        raise ValueError(f"unknown cast mode {mode!r}")
    return F.when(
        src.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"cannot cast {label or 'value'} to double: "), src.cast("string"))),
    ).otherwise(parsed)


def cast_numeric(
    df: DataFrame,
    columns: Sequence[str],
    *,
    strip_commas: Iterable[str] = (),
    mode: str = "strict",
) -> DataFrame:
    """cast text columns to double; ``,`` is removed first only in the
    columns named by ``strip_commas``.

    ``strict``: every row that is read is checked in all of ``columns``, whichever are
    selected afterwards (the check is a filter, which column pruning leaves alone)."""
    commas = set(strip_commas)
    if mode == "strict":
        malformed = F.coalesce(*[F.when(bad, F.concat(F.lit(f"cannot cast {c} to double: "), src.cast("string")))
                                 for c in columns for src, bad in [_not_numeric(c, commas)]]) if columns else F.lit(None)
        df = df.where(F.when(malformed.isNotNull(), F.raise_error(malformed)).otherwise(F.lit(True)))
    elif mode != "null":
        raise ValueError(f"unknown cast mode {mode!r}")
    return df.withColumns({c: to_double(qcol(c), strip="," if c in commas else None, mode="null") for c in columns})


def _not_numeric(name: str, commas: set[str]) -> tuple[Column, Column]:
    """A column as it is cast, and whether it is present but not a number."""
    src = F.replace(qcol(name), F.lit(","), F.lit("")) if name in commas else qcol(name)
    return src, src.isNotNull() & as_double(src).isNull()


def quarantine_rows(df: DataFrame, columns: Sequence[str], *, strip_commas: Iterable[str] = ()) -> DataFrame:
    """Rows of ``df`` where any of ``columns`` is present but not a number
    (the rows F6's strict mode would fail on)."""
    commas = set(strip_commas)
    bad = F.lit(False)
    for c in columns:
        bad = bad | _not_numeric(c, commas)[1]
    return df.filter(bad)


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column subset."""
    return df.select(*[qcol(c) for c in columns])


# ---- F8 predicates ----------------------------------------------------------

def is_missing(c: str | Column) -> Column:
    col = qcol(c) if isinstance(c, str) else c
    return col.isNull()


def is_present(c: str | Column) -> Column:
    col = qcol(c) if isinstance(c, str) else c
    return col.isNotNull()


def in_list(c: str | Column, values: Sequence) -> Column:
    col = qcol(c) if isinstance(c, str) else c
    return col.isin(list(values))


def any_of(*conditions: Column) -> Column:
    out = F.lit(False)
    for cond in conditions:
        out = out | cond
    return out
