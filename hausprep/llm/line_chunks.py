"""Line dedup by content-defined chunks (operator 10); DataFrame functions only.

A text is a sequence of lines.  Every line has a hash; a rolling hash (a
polynomial over a window of two line hashes) moves along the lines, and a chunk
ends where it has a local minimum.  Such ends depend on a few lines around them
alone, so a passage is cut alike wherever it stands, whatever stands before it;
two ends are at least two lines apart.  A line of ``LONG_WORDS`` words or more is
a chunk by itself, so that long passages written as one line are found too.

Chunks of two non-blank lines or more, and long lines, that occur more than once
in the corpus are removed except for the first occurrence (lowest id, then
place).  Occurrences meet by their digest and are compared byte by byte: the
grouping key holds the chunk's text.  Should a digest ever stand for two
different texts, its chunks stay.

Two ends rarely both fall into a passage of a few lines.  ``passages`` also looks up,
for every non-blank line, the shortest run of whole lines of ``LONG_WORDS`` words or
more that starts there, and the shortest that ends there: runs of both kinds cover
every line of a longer passage wherever it stands.  Runs whose hash repeats are
compared byte by byte like chunks; all but the first occurrence go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import fresh_name, lookup
from hausprep.session import materialize

LONG_WORDS = 50
_FACTOR, _PRIME = 31, 2_147_483_647
#: At each start of a non-blank line with so many words after it: the shortest run of whole lines that holds them.
_RUN = r"(?dm)^(?=([^\S\n]*(?:\S++\s++){%d}\S[^\n]*))" % (LONG_WORDS - 1)


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _is_long(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) >= LONG_WORDS - 1


def _adjacent(values: Column, n: Column, f) -> Column:
    """``f`` of each element and the next one."""
    return F.zip_with(F.slice(values, 1, n - 1), F.slice(values, 2, n - 1), f)


def _with_ends(rows: DataFrame) -> DataFrame:
    """Adds ``ends``: the line numbers (exclusive) at which chunks end, without the text's own end.

    What is read more than once is a column of its own in a step before, so that it is computed once."""
    n = F.size("lines")
    given = rows.columns
    rows = rows.select(*given, F.transform("lines", _line_hash).alias("hashes"), F.transform("lines", _is_long).alias("long"))
    rows = rows.select(*given, "long", _adjacent(F.col("hashes"), n, lambda a, b: (a * _FACTOR + b) % _PRIME).alias("rolling"))
    inner = F.greatest(n - 3, F.lit(0))
    falls = F.zip_with(F.slice("rolling", 1, inner), F.slice("rolling", 2, inner), lambda a, b: F.when(b < a, b))
    minima = F.zip_with(falls, F.slice("rolling", 3, inner), lambda b, c: F.coalesce(b <= c, F.lit(False)))
    # Before the third line no minimum can be told.
    minima = F.concat(F.array(F.lit(False), F.lit(False)), minima)
    beside_long = _adjacent(F.col("long"), n, lambda a, b: a | b)
    ends = F.zip_with(minima, beside_long, lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))
    numbered = F.transform(ends, lambda end, i: F.when(end, i + 1))
    return rows.select(*given, F.filter(numbered, lambda e: e < n).alias("ends"))


def _occurrences(docs: DataFrame) -> DataFrame:
    """One row per chunk that may be removed: ``id, text_hash, first, last`` (lines), ``digest, piece``."""
    rows = docs.where(F.col("id").isNotNull() & F.col("text").isNotNull()) \
        .select("id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n", -1).alias("lines"))
    rows = _with_ends(rows)
    n = F.size("lines")
    spans = F.zip_with(F.concat(F.array(F.lit(0)), "ends"), F.concat("ends", F.array(n)), lambda a, b: F.struct(
        a.alias("first"), b.alias("last"), F.slice("lines", a + 1, b - a).alias("own")))
    rows = rows.select("id", "text_hash", F.explode(spans).alias("c")).select("id", "text_hash", "c.*")
    solid = F.size(F.filter("own", lambda x: F.length(F.trim(x)) > 0))
    rows = rows.where((solid >= 2) | ((F.size("own") == 1) & _is_long(F.element_at("own", 1))))
    piece = F.array_join("own", "\n")
    return rows.select("id", "text_hash", "first", "last", F.coalesce(F.md5(piece), F.lit("")).alias("digest"), piece.alias("piece"))


def _place(row: DataFrame) -> Column:
    """Order of occurrences as one number: by id, then by line."""
    return row["id"].cast("decimal(38,0)") * F.lit(1 << 31).cast("decimal(11,0)") + row["first"]


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``id, text_hash, first, last`` of the occurrences to remove, for ``docs(id, text)``."""
    found = _occurrences(docs)
    found = found.withColumn("place", _place(found))
    same = found.groupBy("digest", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"))
    repeated = same.groupBy("digest").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"),
                                          F.min("place").alias("kept")) \
        .where((F.col("n") > 1) & (F.col("texts") == 1)).select("digest", "kept")
    return found.drop("piece").join(repeated, "digest").where(F.col("place") != F.col("kept")) \
        .select("id", "text_hash", "first", "last")


def _run_spans(rows: DataFrame) -> DataFrame:
    """Adds ``runs``: the spans of lines to look up, each once, as ``first << 31 | last`` (exclusive), for ``text, lines``.

    The runs found are those of the first so many non-blank lines, as only the last lines have too few words after them."""
    solid = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(r"\S"), i)), lambda i: i.isNotNull())
    rows = rows.select("*", solid.alias("solid"), F.reverse(solid).alias("from_end"))
    height = lambda run: F.octet_length(run) - F.octet_length(F.replace(run, F.lit("\n"), F.lit(""))) + 1
    span = lambda first, last: F.shiftleft(first.cast("long"), 31).bitwiseOR(last.cast("long"))
    runs = lambda text, f: F.transform(F.regexp_extract_all(text, F.lit(_RUN), F.lit(1)), f)
    starting = runs(F.col("text"), lambda run, k: span(F.get("solid", k), F.get("solid", k) + height(run)))
    ending = runs(F.reverse(F.col("text")), lambda run, k: span(F.get("from_end", k) + 1 - height(run), F.get("from_end", k) + 1))
    return rows.select("*", F.array_union(starting, ending).alias("runs")).drop("solid", "from_end")


def _with_chunks(rows: DataFrame) -> DataFrame:
    """Adds ``chunks``: the spans of the chunks that may be removed, like ``runs``, for ``lines``."""
    given = rows.columns
    rows = _with_ends(rows)
    span = lambda a, b: F.shiftleft(a.cast("long"), 31).bitwiseOR(b.cast("long"))
    spans = F.zip_with(F.concat(F.array(F.lit(0)), "ends"), F.concat("ends", F.array(F.size("lines"))), lambda a, b: F.struct(
        span(a, b).alias("span"), F.slice("lines", a + 1, b - a).alias("own")))
    solid = lambda own: F.size(F.filter(own, lambda x: F.length(F.trim(x)) > 0))
    spans = F.filter(spans, lambda s: (solid(s["own"]) >= 2) | ((F.size(s["own"]) == 1) & _is_long(F.element_at(s["own"], 1))))
    return rows.select(*given, F.transform(spans, lambda s: s["span"]).alias("chunks"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``id, text_hash, first, last`` of the chunks and runs of lines to remove, for ``docs(id, text)``.

    The first occurrence is that of the lowest id, then line, then text hash.  Occurrences that overlap it stay.

    Only a hash and a place are sent for each span; texts meet only for spans whose hash repeats, read again
    from their documents.  No span is grouped or joined by a hash that many rows share: hashes are counted within
    each task before they meet, and the frequent ones are looked up by broadcast."""
    docs = docs.where(F.col("id").isNotNull() & F.col("text").isNotNull()).withColumn("text_hash", F.xxhash64("text"))
    rows = _with_chunks(_run_spans(docs.withColumn("lines", F.split("text", "\n", -1))))
    first, last = (lambda s: F.shiftright(s, 31).cast("int")), (lambda s: s.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    own = lambda lines, s: F.array_join(F.slice(lines, first(s) + 1, last(s) - first(s)), "\n")
    hashed = F.transform(F.array_union("chunks", "runs"), lambda s: F.struct(s.alias("span"), F.xxhash64(own(F.col("lines"), s)).alias("hash")))
    found = materialize(rows.select("id", "text_hash", F.explode(hashed).alias("r")).select("id", "text_hash", "r.*"), "spans")
    often = materialize(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "span_hashes")
    spans = lookup(found, often, "hash", "n", how="inner").groupBy("id", "text_hash").agg(F.collect_set("span").alias("spans"))
    # Only of documents with such spans are the texts made.
    rows = docs.join(spans, ["id", "text_hash"]).withColumn("lines", F.split("text", "\n", -1))
    pieces = F.transform("spans", lambda s: F.struct(s.alias("span"), own(F.col("lines"), s).alias("piece")))
    found = rows.select("id", "text_hash", F.explode(pieces).alias("p")).select("id", "text_hash", "p.*")
    place = F.struct("id", first(F.col("span")).alias("first"), "text_hash", last(F.col("span")).alias("last"))
    found = materialize(found.select(F.md5("piece").alias("digest"), "piece", place.alias("place")), "pieces")
    same = found.groupBy("digest", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("kept"))
    same = same.groupBy("digest").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"), F.min("kept").alias("kept"))
    same = materialize(same.where((F.col("n") > 1) & (F.col("texts") == 1)), "span_digests")
    found = lookup(found.drop("piece"), same, "digest", "n", how="inner")
    overlaps = (F.col("place.id") == F.col("kept.id")) & (F.col("place.text_hash") == F.col("kept.text_hash")) \
        & (F.col("place.first") < F.col("kept.last"))
    return found.where((F.col("place") != F.col("kept")) & ~overlaps).select("place.*")


def dedup_lines(docs: DataFrame, lines: str | None = None, removed: str | None = None, passages: bool = False) -> DataFrame:
    """``docs`` without repeated chunks, in the same columns; ``lines`` and ``removed`` name columns to add
    with the number of lines before and of removed lines.  With ``passages``, no passage of ``LONG_WORDS`` words
    or more in whole lines stays a second time.

    Rows with a null id or text stay as they are (a null text has 0 lines).  A text may become empty.  Rows
    with the same id and the same text are one document for the first occurrence, so they keep the same
    lines; rows with the same id and different texts are handled by their own text.
    """
    key, hashed, gone = (fresh_name(docs, c) for c in ("key__", "hash__", "gone__"))
    read = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
    cut = (materialize(repeated_spans(read), "cuts") if passages else repeated_chunks(read))
    cut = cut.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias(gone))
    if passages:      # these overlap: spans of one line each instead
        numbers = F.flatten(F.transform(gone, lambda s: F.sequence(s["first"], s["last"] - 1)))
        cut = cut.withColumn(gone, F.array_sort(F.array_distinct(numbers))) \
            .withColumn(gone, F.transform(gone, lambda i: F.struct(i.alias("first"), (i + 1).alias("last"))))
    cut = cut \
        .withColumnsRenamed({"id": key, "text_hash": hashed})
    rows = docs.withColumn(key, docs["doc_id"].cast("long")).withColumn(hashed, F.xxhash64(docs["text"]))
    named = rows.where(F.col(key).isNotNull()).join(cut, [key, hashed], "left")
    unnamed = rows.where(F.col(key).isNull()).withColumn(gone, F.lit(None).cast(cut.schema[gone].dataType))
    rows = named.unionByName(unnamed)
    # The lines are a column of their own, read more than once below: so the plan keeps it as one, and the
    # lambda does not split the text again for every span.
    whole = fresh_name(docs, "whole__")
    rows = rows.withColumn(whole, F.split("text", "\n", -1))
    kept = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform(gone, lambda s: s["last"])),
        F.concat(F.transform(gone, lambda s: s["first"]), F.array(F.size(whole))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rebuilt = F.array_join(F.flatten(F.transform(kept, lambda s: F.slice(F.col(whole), s["a"] + 1, s["b"] - s["a"]))), "\n")
    columns = [F.when(F.col(gone).isNull(), F.col(c)).otherwise(rebuilt).alias(c) if c == "text" else F.col(c)
               for c in docs.columns]
    if lines:
        columns.append(F.when(F.col("text").isNull(), 0).otherwise(F.size(whole)).cast("long").alias(lines))
    if removed:
        columns.append(F.coalesce(F.aggregate(gone, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"]),
                                  F.lit(0).cast("long")).alias(removed))
    return rows.select(*columns)


#: The same for the registered query, in DuckDB SQL.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line, len(ls) AS n FROM d WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h,
             length(line) - length(replace(line, ' ', '')) >= {LONG_WORDS - 1} AS long FROM l),
r AS (SELECT *, (lag(h) OVER w * {_FACTOR} + h) % {_PRIME} AS r, lead(long) OVER w AS long_next FROM h
      WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT *, i < n AND (long OR long_next OR (i >= 3 AND r < lag(r) OVER w AND r <= lead(r) OVER w)) AS ends FROM r
      WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
      FROM (SELECT doc_id, i, line, long, coalesce(ends, false) AS ends FROM e)),
c AS (SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS piece, count(*) AS k,
             count(*) FILTER (WHERE trim(line, ' ') <> '') AS solid, bool_or(long) AS long FROM g GROUP BY ALL),
o AS (SELECT doc_id, chunk, row_number() OVER (PARTITION BY piece ORDER BY doc_id, chunk) > 1 AS again
      FROM c WHERE solid >= 2 OR (k = 1 AND long)),
k AS (SELECT g.doc_id, g.i, g.line, coalesce(o.again, false) AS again FROM g LEFT JOIN o USING (doc_id, chunk)),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_removed_lines,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT again), '') AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed_lines, 0)::BIGINT AS n_removed_lines,
       sha256(t.text) AS text_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_lines, n_removed_lines, text_sha256`` of the text that stays (null for a null text)."""
    out = dedup_lines(docs.select(docs["doc_id"], docs["text"]), "n_lines", "n_removed_lines")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed_lines",
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
