"""Imputation and conditional updates (I1-I7) as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hausprep.functions.tokens import has_any, replace_literal, token_key, tokens_match, yes_no
from hausprep.operators.schema import as_double


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_constant(c: Column | str, value) -> Column:
    """Missing -> constant (works for string and numeric columns)."""
    return F.coalesce(_col(c), F.lit(value))


def fill_from_column(primary: Column | str, fallback: Column | str, remove: str | None = None) -> Column:
    """``primary`` (with a literal suffix such as `` SQFT`` removed),
    falling back to ``fallback`` where missing."""
    p = _col(primary)
    if remove:
        p = replace_literal(p, remove)
    return F.coalesce(p, _col(fallback))


def correct_value(c: Column | str, bad: float, good) -> Column:
    """Replace a known-bad numeric value.  Text cells are compared by
    their numeric value; cells that are not numbers are left alone."""
    col = _col(c)
    return F.when(as_double(col) == F.lit(float(bad)), F.lit(good)).otherwise(col)


def presence_flag(c: Column | str, absent_values: Sequence[str]) -> Column:
    """I4: ``Yes`` when the raw cell is present and not an "absent" marker."""
    col = _col(c)
    return yes_no(col.isNotNull() & ~col.isin(list(absent_values)))


def garage_fill(
    garage: Column | str,
    features: Column | str,
    parking: Column | str,
    hit_features: Column,
    hit_parking: Column,
) -> Column:
    """A missing garage is decided from the features, a ``No`` garage
    from the parking cell; any other value is kept.  ``hit_*`` are the
    boolean membership tests of those cells in the garage vocabulary."""
    g = _col(garage)
    return F.when(g.isNull(), yes_no(hit_features)).when(g == F.lit("No"), yes_no(hit_parking)).otherwise(g)


def parking_fill(parking: Column | str, features: Column | str, terms: Sequence[str]) -> Column:
    """``Yes`` when the parking cell, or failing that the features cell,
    names any parking term."""
    cells = [tokens_match(parking), tokens_match(features)]
    return yes_no(has_any(cells[0], terms, key=token_key(cells[0])) | has_any(cells[1], terms, key=token_key(cells[1])))


def remap_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Map known values to labels; other values are kept unchanged."""
    col = _col(c)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, col), col)
