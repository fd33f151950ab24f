"""Schema and load preparation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.common import qcol
from hausprep.vocabularies import NA_TOKENS


def na_tokens(df: DataFrame, columns: Iterable[str] | None = None,
              tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Textual missing-value markers -> null in string columns.
    Exact and case-sensitive: ``None`` becomes null, ``none`` stays."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    toks = list(tokens)
    return df.withColumns({c: F.when(~qcol(c).isin(toks), qcol(c)) for c in df.columns if c in targets})


def dedupe_column_names(names: Sequence[str]) -> list[str]:
    """The n-th repeat of a name becomes ``name_n`` (first unchanged);
    a generated name that is already taken is bumped until unique."""
    taken = set(names)
    seen: dict[str, int] = {}
    out: list[str] = []
    for name in names:
        if name not in seen:
            seen[name] = 0
            out.append(name)
            continue
        n = seen[name]
        while True:
            n += 1
            candidate = f"{name}_{n}"
            if candidate not in taken:
                break
        seen[name] = n
        taken.add(candidate)
        out.append(candidate)
    return out


def dedupe_columns(df: DataFrame) -> DataFrame:
    """C2 on a frame whose column names repeat."""
    return df.toDF(*dedupe_column_names(df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> null in float and double columns."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(qcol(c)), qcol(c)) for c in floats})


_BOOL_SPELLINGS = ["true", "false"]
# Shapes of integer and decimal text.  The cast is only attempted on text of
# that shape: a failing cast costs an exception per value, and the shape
# test also rejects spellings a CSV reader would not call numbers (``1.5d``).
_INT_SHAPE = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT_SHAPE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"


def as_bigint(c: Column) -> Column:
    """Text -> bigint when the text is an integer in range, else null."""
    return F.when(c.rlike(_INT_SHAPE), c.try_cast("bigint"))


def as_double(c: Column) -> Column:
    """Text -> double when the text is a decimal number, else null."""
    return F.when(c.rlike(_FLOAT_SHAPE), c.try_cast("double"))


#: Formats that dates are written in, most usual reading first (month before day, as
#: in the original's parser), each with the shape a value must have to be tried.
DATE_FORMATS = (
    ("M/d/yyyy", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    ("d/M/yyyy", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    ("M-d-yyyy", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
    ("d-M-yyyy", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
    ("yyyy/M/d", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"),
    ("d.M.yyyy", r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"),
    ("MMMM d, yyyy", r"^[A-Z][a-z]{2,8} [0-9]{1,2}, [0-9]{4}$"),
    ("MMM d, yyyy", r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}$"),
    ("d MMMM yyyy", r"^[0-9]{1,2} [A-Z][a-z]{2,8} [0-9]{4}$"),
    ("d MMM yyyy", r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}$"),
    ("M/d/yyyy H:mm", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}$"),
    ("d/M/yyyy H:mm", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}$"),
)


def as_date(c: Column, fmt: str | None = None) -> Column:
    """Text -> date by one of ``DATE_FORMATS``, by default an ISO date or timestamp; else null."""
    if fmt is None:
        return F.coalesce(c.try_cast("date"), F.to_date(c.try_cast("timestamp")))
    return F.when(c.rlike(dict(DATE_FORMATS)[fmt]), F.to_date(F.try_to_timestamp(c, F.lit(fmt))))


def _date_mask(c: Column) -> Column:
    """A bit for each way to read the text as a date: 1 for ISO, then one for each of ``DATE_FORMATS``."""
    mask = F.when(as_date(c).isNotNull(), 1).otherwise(0)
    for k, (fmt, _) in enumerate(DATE_FORMATS):
        mask = mask.bitwiseOR(F.when(as_date(c, fmt).isNotNull(), 2 << k).otherwise(0))
    return mask


def date_type(mask: int | None) -> str | None:
    """``date``, or ``date`` with a format in brackets: the first way in which all values of a column can be read."""
    if not mask:
        return None
    first = (mask & -mask).bit_length() - 1
    return "date" if first == 0 else f"date[{DATE_FORMATS[first - 1][0]}]"


def _type_probes(c: Column, i: int) -> list[Column]:
    present = c.isNotNull()
    return [
        F.count(c).alias(f"p{i}"),
        F.count_if(present & as_bigint(c).isNull()).alias(f"ni{i}"),
        F.count_if(present & as_double(c).isNull()).alias(f"nd{i}"),
        F.count_if(present & ~F.lower(c).isin(_BOOL_SPELLINGS)).alias(f"nb{i}"),
    ]


def infer_types(df: DataFrame) -> DataFrame:
    """A type per column inferred from the data, as a frame
    ``(ordinal, column_name, inferred_type, date_format)``.

    Text columns are probed in one aggregate over all columns; only one row
    of counts reaches the driver.  Rules: all integers -> ``bigint``
    (integers with any missing -> ``double``); all numbers -> ``double``;
    all ``true``/``false`` without missing -> ``boolean``; name contains
    ``date`` and all values can be read as dates in one and the same format (ISO, else the
    first of ``DATE_FORMATS``, given as ``date_format``) -> ``date``; all missing ->
    ``double``; else ``string``.  Already-typed columns keep their type.
    """
    spark = df.sparkSession
    rows = []
    for i, (name, kind) in enumerate(inferred_schema(df).items()):
        fmt = kind[5:-1] if kind.startswith("date[") else None
        rows.append((i, name, "date" if fmt else kind, fmt))
    return spark.createDataFrame(rows, "ordinal int, column_name string, inferred_type string, date_format string")


def inferred_schema(df: DataFrame) -> dict[str, str]:
    """C3 as a ``{column: spark type name}`` mapping (ordered); a date not in ISO form is ``date[<format>]``."""
    fields = list(df.schema.fields)
    text = [(i, f) for i, f in enumerate(fields) if isinstance(f.dataType, T.StringType)]
    probes = [p for i, f in text for p in _type_probes(qcol(f.name), i)]
    probes += [F.bit_and(F.when(qcol(f.name).isNotNull(), _date_mask(qcol(f.name)))).alias(f"d{i}")
               for i, f in text if "date" in f.name.lower()]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *probes).first() if probes else None
    out: dict[str, str] = {}
    for i, f in enumerate(fields):
        if not isinstance(f.dataType, T.StringType):
            out[f.name] = f.dataType.simpleString()
            continue
        rows, present = counts["rows"], counts[f"p{i}"]
        missing = rows - present
        if present == 0:
            out[f.name] = "double"
        elif counts[f"ni{i}"] == 0:
            out[f.name] = "bigint" if missing == 0 else "double"
        elif counts[f"nd{i}"] == 0:
            out[f.name] = "double"
        elif counts[f"nb{i}"] == 0 and missing == 0:
            out[f.name] = "boolean"
        elif "date" in f.name.lower() and date_type(counts[f"d{i}"]):
            out[f.name] = date_type(counts[f"d{i}"])
        else:
            out[f.name] = "string"
    return out


def apply_types(df: DataFrame, types: dict[str, str], *, strict: bool = True) -> DataFrame:
    """Cast text columns to the types chosen by :func:`inferred_schema`."""
    exprs = {}
    for name, type_name in types.items():
        field = df.schema[name]
        if field.dataType.simpleString() == type_name:
            continue
        c = qcol(name)
        if type_name == "boolean":
            cast = F.when(F.lower(c) == "true", F.lit(True)).when(F.lower(c) == "false", F.lit(False))
        elif type_name.startswith("date"):
            cast = as_date(c, type_name[5:-1] or None)
        elif type_name == "bigint":
            cast = as_bigint(c)
        elif type_name == "double":
            cast = as_double(c)
        else:
            cast = c.try_cast(type_name)
        if strict:
            cast = F.when(c.isNotNull() & cast.isNull(),
                          F.raise_error(F.concat(F.lit(f"bad {type_name} in {name}: "), c.cast("string")))
                          ).otherwise(cast)
        exprs[name] = cast
    return df.withColumns(exprs) if exprs else df
