"""Set operations: union by name (U1), duplicate rows (U2), duplicate
columns (U3) and vocabulary union (U4)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hausprep.operators.common import qcol


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate rows; the output has the union of all column names,
    columns missing from a frame are null there."""
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Text cells of a row are put in one key, with a separator and a mark for null; cells that hold one of these are escaped.
_ESCAPE, _NULL, _CELL_END = "\x1d", "\x1e", "\x1f"
_ESCAPED = ((_ESCAPE, _ESCAPE + "0"), (_NULL, _ESCAPE + "1"), (_CELL_END, _ESCAPE + "2"))


def _packed(cells: Column, text: Column) -> Column:
    """An array of text cells as one text; different rows have different texts.  ``text``: the cells one after another, a column of its own, as it is searched three times."""
    def escaped(c):
        for mark, code in _ESCAPED:
            c = F.replace(c, F.lit(mark), F.lit(code))
        return c

    odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(mark)) for mark, _ in _ESCAPED])
    pack = lambda cs: F.array_join(cs, _CELL_END, _NULL)
    return F.when(odd, pack(F.transform(cells, escaped))).otherwise(pack(cells))


def _unpacked(row: Column, n: int) -> Column:
    """The ``n`` cells of :func:`_packed`; a null cell is null in rows with an escaped one, else ``_NULL``.  Text that is no UTF-8 is cut out by bytes, and stays as it is."""
    def decoded(c):
        plain = c
        for mark, code in reversed(_ESCAPED):
            plain = F.replace(plain, F.lit(code), F.lit(mark))
        return F.when(c != _NULL, plain)

    by_bytes = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.call_function(
        "substring_index", F.call_function("substring_index", row, F.lit(_CELL_END), i), F.lit(_CELL_END), F.lit(-1)))
    cells = F.when(F.is_valid_utf8(row), F.split(row, _CELL_END, -1)).otherwise(by_bytes)
    return F.when(F.contains(row, F.lit(_ESCAPE)), F.transform(cells, decoded)).otherwise(cells)


def distinct_rows(df: DataFrame, canonical_numeric: Iterable[str] = (), *, packed: bool = False) -> DataFrame:
    """Drop fully duplicated rows; missing equals missing.

    Spark plans this as a partial hash aggregate before the shuffle, so a
    value repeated a billion times crosses the network at most once per map
    task.  With ``packed`` the text cells of a row are one key in it, which takes half the space
    of a column each and so spills less, at the price of putting the cells together and taking them
    apart; Spark then no longer drops equal branches of a union.  ``canonical_numeric`` names text columns whose numeric spelling
    should not matter (see :func:`numeric_key`): rows that are equal but for it
    become one row, the least of them in these columns, its text as it was
    (:func:`merge_spellings`)."""
    text = [f.name for f in df.schema.fields if f.dataType == T.StringType()]
    out = df
    if not packed or len(text) < 2 or len({c.lower() for c in df.columns}) < len(df.columns):
        out = df.dropDuplicates()
    else:
        others = [c for c in df.columns if c not in text]
        kept = [qcol(c).alias(f"k{i}") for i, c in enumerate(others)]
        keyed = df.select(F.array(*[qcol(c) for c in text]).alias("cells"), *kept)
        keyed = keyed.withColumn("text", F.array_join("cells", ""))
        keyed = keyed.select(_packed(F.col("cells"), F.col("text")).alias("row"), *[f"k{i}" for i in range(len(others))]).distinct()
        rows = keyed.select(_unpacked(F.col("row"), len(text)).alias("cells"), F.contains("row", F.lit(_ESCAPE)).alias("decoded"),
                            *[f"k{i}" for i in range(len(others))])
        value = lambda c: F.col("cells")[text.index(c)]
        cell = lambda c: F.when(F.col("decoded") | (value(c) != _NULL), value(c))
        out = rows.select(*[(cell(c) if c in text else F.col(f"k{others.index(c)}")).alias(c) for c in df.columns])
    return merge_spellings(out, canonical_numeric)


def spelled_otherwise(df: DataFrame, canonical_numeric: Iterable[str]) -> Column:
    """Whether a row spells a number of these text columns in another way than :func:`numeric_key`."""
    odd = F.lit(False)
    for c in canonical_numeric:
        odd = odd | F.coalesce(numeric_key(qcol(c)) != qcol(c), F.lit(False))
    return odd


def merge_spellings(df: DataFrame, canonical_numeric: Iterable[str]) -> DataFrame:
    """Of distinct rows that are equal but for the spelling of numbers, the least one.

    Rows are dealt out by their hash before they are aggregated: distinct rows do not shrink before the
    shuffle, and so the sort which a kept text needs compares one number, once."""
    numeric = [c for c in df.columns if c in set(canonical_numeric)]
    if not numeric:
        return df
    keys = [numeric_key(qcol(c)) if c in numeric else qcol(c) for c in df.columns]
    keyed = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)], F.struct(*[qcol(c).alias(f"t{i}") for i, c in enumerate(numeric)]).alias("text"))
    names = keyed.columns[:-1]
    keyed = keyed.withColumn("row_hash", F.xxhash64(*names)).repartition("row_hash")
    kept = keyed.groupBy("row_hash", *names).agg(F.min("text").alias("text"))
    return kept.select(*[(F.col(f"text.t{numeric.index(c)}") if c in numeric else F.col(f"k{i}")).alias(c) for i, c in enumerate(df.columns)])


_DIGITS = 40
_DECIMAL = r"^(?=\.?[0-9])[0-9]{0,%d}(\.[0-9]{0,%d})?$" % (_DIGITS, _DIGITS)
_NUMBER = r"^([+-]?)(?=\.?[0-9])([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]{1,9}))?$"


def _spelled(p: Column) -> Column:
    """``sign``, ``digits`` and ``power`` of ten as a number, written out if it is not too long."""
    digits, power, n = p["digits"], p["power"], F.length(p["digits"])
    out = F.when((power >= 0) & (n + power <= 2 * _DIGITS), F.rpad(digits, n + power, F.lit("0"))) \
        .when((power < 0) & (n + power > 0) & (n <= 2 * _DIGITS), F.concat(F.left(digits, n + power), F.lit("."), F.right(digits, -power))) \
        .when((power < 0) & (n + power <= 0) & (power >= -_DIGITS), F.concat(F.lit("0."), F.lpad(digits, -power, F.lit("0")))) \
        .otherwise(F.concat(digits, F.lit("e"), power))
    return F.when(digits == "", "0").when(p["sign"] == "-", F.concat(F.lit("-"), out)).otherwise(out)


def numeric_key(text: Column) -> Column:
    """One spelling for equal decimal numbers: ``3``, ``3.0``, ``+3``, ``03.`` and ``0.3e1`` give ``3``, ``.5`` gives ``0.5``,
    ``1e3`` gives ``1000``.  Digits are handled as text, so numbers of any length and precision stay apart;
    other text is its own key.  Plain integers, the most frequent case, are recognised without a regular expression."""
    zero, point = F.lit("0"), F.lit(".")
    odd = F.contains(text, point) | F.contains(text, F.lit("e")) | F.contains(text, F.lit("E")) | F.startswith(text, zero) \
        | F.startswith(text, F.lit("+")) | F.startswith(text, F.lit("-")) | (F.octet_length(text) > _DIGITS)
    # Digits and a point: zeros at both ends go.
    short = F.ltrim(F.when(F.contains(text, point), F.rtrim(F.rtrim(text, zero), point)).otherwise(text), zero)
    short = F.when((short == "") | F.startswith(short, point), F.concat(zero, short)).otherwise(short)
    # Any other number, in steps whose values are named by a lambda, so that none is worked out twice.
    let = lambda value, f: F.transform(F.array(value), f)[0]
    part = lambda k: F.regexp_extract(text, _NUMBER, k)
    parts = F.struct(part(1).alias("sign"), F.ltrim(F.concat(part(2), part(3)), zero).alias("whole"), F.length(part(3)).alias("places"),
                     F.coalesce(part(4).try_cast("int"), F.lit(0)).alias("exponent"))
    # The digits without zeros at both ends, and the power of ten of the last one.
    stripped = lambda p: F.struct(p["sign"].alias("sign"), F.rtrim(p["whole"], zero).alias("digits"), (
        p["exponent"] - p["places"] + F.length(p["whole"]) - F.length(F.rtrim(p["whole"], zero))).alias("power"))
    signed = let(let(parts, stripped), _spelled)
    return F.when(~odd, text).when(text.rlike(_DECIMAL), short).when(text.rlike(_NUMBER), signed).otherwise(text)


def canonical_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text columns replaced by their :func:`numeric_key`."""
    found = {c: numeric_key(qcol(c)) for c in columns}
    return df.withColumns(found) if found else df


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _family(dt: T.DataType) -> str:
    return "numeric" if isinstance(dt, _NUMERIC) else dt.simpleString()


def _canonical(c: str, dt: T.DataType) -> Column:
    col = qcol(c)
    if isinstance(dt, _NUMERIC):
        d = col.cast("double")
        # -0.0 equals 0.0 and must hash alike.
        return F.when(d == F.lit(0.0), F.lit(0.0)).otherwise(d)
    return col


def fingerprint_exprs(df: DataFrame, row_hash: Column | None = None) -> list[Column]:
    """Pass 1 of U3 as aggregate expressions (``h<i>``, ``s<i>``, ``n<i>`` per column).
    They can also ride along another job, e.g. ``DataFrame.observe`` on the
    write that materialises the frame, so pass 1 costs no scan of its own.
    ``row_hash``: the hash of all cells of a row, if it is a column already."""
    fields = list(df.schema.fields)
    row_hash = F.xxhash64(*[qcol(f.name) for f in fields]) if row_hash is None else row_hash
    aggs = []
    for i, f in enumerate(fields):
        value_hash = F.xxhash64(row_hash, _canonical(f.name, f.dataType))
        aggs.append(F.bit_xor(value_hash).alias(f"h{i}"))
        # Rows that occur an even number of times cancel out above, not in a sum; of 24 bits each, 2 ** 40 rows fit a bigint.
        aggs.append(F.sum(F.shiftright(value_hash, 40)).alias(f"s{i}"))
        aggs.append(F.count_if(qcol(f.name).isNull()).alias(f"n{i}"))
    return aggs


def column_fingerprints(df: DataFrame, *more: Column) -> Row:
    """:func:`fingerprint_exprs` (and ``more`` aggregates) by a scan of their own, which works out the hash of a row once and not for each column."""
    name = "row_hash" + "_" * max(map(len, df.columns))      # longer than any column's
    hashed = df.withColumn(name, F.xxhash64(*[qcol(c) for c in df.columns]))
    return hashed.agg(*fingerprint_exprs(df, F.col(name)), *more).first()


def duplicate_columns(df: DataFrame, protect: Iterable[str] = (), *, fingerprints=None) -> list[str]:
    """Names of the columns U3 removes, in column order.

    A column is a duplicate when it equals an earlier column on every row
    (missing equals missing; numbers compare by value, text never equals a
    number).  Protected columns are never removed; a column equal to a
    protected column is removed instead.

    Pass 1 is a single aggregate: per column an order-insensitive
    fingerprint (``bit_xor`` and a sum of ``xxhash64(row_hash, value)``) plus its null count.
    Equal columns always get equal fingerprints, so only columns sharing a
    fingerprint need pass 2, an exact ``bool_and(a <=> b)`` of each with
    one of them.  Only one row of per-column numbers reaches the driver.
    """
    fields = list(df.schema.fields)
    if len(fields) < 2:
        return []
    protected = set(protect)
    prints = fingerprints if fingerprints is not None else column_fingerprints(df)

    groups: dict[tuple, list[int]] = {}
    for i, f in enumerate(fields):
        key = (_family(f.dataType), prints[f"h{i}"], prints[f"s{i}"], prints[f"n{i}"])
        groups.setdefault(key, []).append(i)
    # Equality is transitive: members are held against one of them, and those that differ form a new group.
    open_groups = [m for m in groups.values() if len(m) > 1]
    equal: dict[int, list[int]] = {}
    while open_groups:
        checks = []
        for first, *rest in open_groups:
            left = _canonical(fields[first].name, fields[first].dataType)
            for b in rest:
                right = _canonical(fields[b].name, fields[b].dataType)
                checks.append(F.bool_and(F.coalesce(left.eqNullSafe(right), F.lit(False))).alias(f"e{b}"))
        verdict = df.agg(*checks).first()
        left_over = []
        for first, *rest in open_groups:
            same = [first, *(b for b in rest if verdict[f"e{b}"] in (True, None))]
            equal |= {i: same for i in same}
            left_over.append([b for b in rest if b not in same])
        open_groups = [m for m in left_over if len(m) > 1]

    dropped: list[str] = []
    for j, f in enumerate(fields):
        if f.name not in protected and any(i < j or (i != j and fields[i].name in protected) for i in equal.get(j, ())):
            dropped.append(f.name)
    return dropped


def distinct_columns(df: DataFrame, protect: Iterable[str] = (), *, fingerprints=None) -> DataFrame:
    """Drop columns that duplicate an earlier column on every row.
    ``fingerprints``: the row of :func:`fingerprint_exprs` if already known."""
    dropped = set(duplicate_columns(df, protect, fingerprints=fingerprints))
    return df.select(*[qcol(c) for c in df.columns if c not in dropped])


def vocab_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: set union of two single-column vocabularies (same column name)."""
    return a.unionByName(b).distinct()
