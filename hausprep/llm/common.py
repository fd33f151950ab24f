"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of text handled at once inside a task; bounds the numpy temporaries.
PIECE_BYTES = 1 << 19

#: Words of lower-cased text: runs of digits, a-z and non-ASCII characters.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Of UTF-8 bytes: A-Z to lower case, what no word holds to a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-case A-Z, then the words of the text (``WORD``), each as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; other columns, whatever they are called, cannot interfere."""
    return df.select(*[df[n] for n in names])


def id_fold(doc_id: Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; null without an id."""
    return (F.crc32(doc_id.cast("string")) % parts).cast("int")


def fold_of(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def in_pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of an Arrow batch of about ``PIECE_BYTES`` bytes of text, each with its texts
    (null becomes empty).  A single longer text is a slice of its own.  Only the texts of one slice
    are Python strings at a time."""
    texts = batch.column(column)
    start, size = 0, 0
    ends = []
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and size + n > PIECE_BYTES:
            ends.append(i)
            start, size = i, 0
        size += n
    start = 0
    for end in [*ends, len(texts)]:
        if start < end:
            yield batch.slice(start, end - start), [t or "" for t in texts.slice(start, end - start).to_pylist()]
        start = end


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t)
         for c, t in zip(columns, schema.types)], schema=schema)


def lookup(rows: DataFrame, values: DataFrame, key: str, n: str, how: str = "left", hot: int = 1000) -> DataFrame:
    """``rows`` joined with ``values``, which has one row per ``key`` and in ``n`` the number of ``rows`` with it.

    The ``hot`` keys of most rows (ties: by key) are broadcast, a table of a fixed number of rows; the rest meet by
    a shuffle in which no key has more than one in ``hot`` of all rows.  Keys must not be null."""
    top = values.orderBy(F.desc(n), key).limit(hot)
    found = rows.join(F.broadcast(top), key, "inner")
    rest = rows.join(F.broadcast(top.select(key)), key, "left_anti").join(values, key, how)
    return found.unionByName(rest)
