"""Spelling variants by dynamic programming over sorted word lists (operator 11).

The vocabulary is sorted, and every word runs down the sorted list with the
rows of its edit matrix, of which only a band of three cells can matter.  What
adjacent words share as a prefix (their LCP) has the same rows, so a row is
computed once for all words of such a range; a range whose shared prefix is
already more than one edit away is skipped whole.  The rows of many words move
down the list together, one depth at a time.

For Spark the list is cut so that every pair is met in one place.  Two words
that are one edit apart, the shorter of ``2t`` or ``2t + 1`` code points, share
their first ``t`` code points (the edit comes later) or their last ``t`` (it
comes earlier).  So there is a list per ``t`` and first half, and one of the
reversed words per ``t`` and last half; a word is in three lists on average.  A list of
more than ``BLOCK`` words is cut into blocks, and each pair of blocks is a unit
of work of its own.  A unit gives one row per word (number of near words, and the
best of them), never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import lookup, record
from hausprep.session import materialize, materialize_observed

RUN = "[A-Za-zÀ-ÿ]+"
BLOCK = 2048               # words of a unit of work, of each of its two blocks
BATCH_LETTERS = 1 << 18    # code points of the lists that a task works on together (one unit at least)
FRONT = 1 << 18            # rows of edit matrices that are moved on at once
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3, drop_every: int | None = None) -> DataFrame:
    """``word, n`` for ``docs(doc_id, text)``: runs of letters, A-Z in lower case, of ``min_length`` code points that
    occur ``min_count`` times in all documents.  With ``drop_every``, a run whose hash ``crc32(<doc_id>:<run>)`` that
    number divides first loses its code point number hash modulo length; without a doc_id none does."""
    rows = docs.select(docs["doc_id"].cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(docs["text"], F.lit(RUN), F.lit(0))).alias("run")) \
        .where(F.char_length("run") >= min_length)
    ascii_only = F.octet_length("run") == F.char_length("run")
    rows = rows.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("word"))
    if drop_every:
        rows = rows.select("word", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")).alias("h"))
        at = (F.col("h") % F.char_length("word")).cast("int")
        rest = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.char_length("word")))
        rows = rows.select(F.when(F.col("h") % drop_every == 0, rest).otherwise(F.col("word")).alias("word"))
    # The length as an aggregate: a filter on the word would move below and compute the word once more.
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max(F.char_length("word")).alias("length")) \
        .where((F.col("n") >= min_count) & (F.col("length") >= min_length)).select("word", "n")


def in_lists(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """The units of work, each in one partition and sorted: ``unit, rest, half, reversed, word, n, own, across``.

    ``rest`` is the word, reversed in lists by last half, without its first ``half`` code points, which all words of
    a unit share; ``own`` is the word's block, ``across`` whether the unit is of two different blocks."""
    length = F.char_length("word")
    half = F.shiftright(length, 1)
    halves = F.when(length % 2 == 0, F.array(half, half - 1)).otherwise(F.array(half))
    lists = words.select("word", "n", F.explode(halves).alias("half")) \
        .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("reversed"))
    spelled = F.when(F.col("reversed"), F.reverse("word")).otherwise(F.col("word"))
    lists = lists.where("half >= 0").withColumn("key", F.concat(
        F.col("half").cast("string"), F.when(F.col("reversed"), "<").otherwise(">"), F.substring(spelled, F.lit(1), F.col("half"))))
    lists = materialize(lists, "lists")
    sizes = materialize(lists.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "list_sizes")
    lists = lookup(lists, sizes, "key", "members", how="inner")
    blocks = F.ceil(F.col("members") / F.lit(block)).cast("int")
    lists = lists.withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    one, two = F.least("own", "other"), F.greatest("own", "other")
    lists = lists.select(
        F.concat_ws(" ", "key", one, two).alias("unit"), F.substring(spelled, F.col("half") + 1, length).alias("rest"),
        "half", "reversed", "word", "n", "own", (one != two).alias("across"))
    return lists.repartition("unit").sortWithinPartitions("unit", "rest")


def near_pairs(rests: list[str], unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``i, j`` (``i < j``) of the distinct words of one unit that are one edit apart; each unit's words are sorted.

    A front is a set of rows of edit matrices at one depth ``d``: word ``q`` against the range ``lo`` to ``hi`` of list
    words that share ``d`` code points, with the cells ``d - 1``, ``d`` and ``d + 1`` of the row."""
    n = len(rests)
    letters = np.frombuffer(("\0".join(rests) + "\0").encode("utf-32-le"), np.uint32)     # a word ends with 0
    size = np.fromiter(map(len, rests), np.int64, n)
    at = np.cumsum(size + 1) - size - 1
    lcp = np.full(n, -1)
    open_ = np.flatnonzero(unit[1:] == unit[:-1]) + 1
    depth = 0
    while len(open_):
        lcp[open_] = depth
        open_ = open_[letters[at[open_] + depth] == letters[at[open_ - 1] + depth]]
        depth += 1

    @lru_cache(maxsize=32)
    def beginnings(depth: int) -> np.ndarray:
        """Where in the list a range of words begins that share ``depth + 1`` code points."""
        return np.flatnonzero(lcp <= depth)

    ends = np.append(np.flatnonzero(unit[1:] != unit[:-1]) + 1, n)
    q = np.arange(n)
    hi = ends[np.searchsorted(ends, q, "right")]
    some = q + 1 < hi                                    # a word runs down what follows it, so a pair is met once
    cell = np.zeros(int(some.sum()), np.int8)
    fronts = [(0, q[some], q[some] + 1, hi[some], cell + 2, cell, cell + 1)]
    while fronts:
        d, q, lo, hi, left, mid, right = fronts.pop()
        starts = beginnings(d)
        first, last = np.searchsorted(starts, lo, "right"), np.searchsorted(starts, hi, "left")
        n_ranges = 1 + last - first
        if len(q) > 1 and n_ranges.sum() > FRONT:
            half = len(q) // 2
            fronts += [(d, *(x[part] for x in (q, lo, hi, left, mid, right))) for part in (slice(half), slice(half, None))]
            continue
        row = np.repeat(np.arange(len(q)), n_ranges)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n_ranges) - n_ranges, n_ranges)
        cut = lambda k: starts[np.minimum(first[row] + k, len(starts) - 1)]
        lo, hi = np.where(k == 0, lo[row], cut(k - 1)), np.where(k == n_ranges[row] - 1, hi[row], cut(k))
        q, left, mid, right = q[row], left[row], mid[row], right[row]
        letter = letters[at[lo] + d]
        # A list word that ends here: the cell in the column of the whole word q tells the distance.
        ended = letter == 0
        off = size[q] - d
        distance = np.where(off == 0, mid, np.where(off == 1, right, np.where(off == -1, left, 2)))
        found = ended & (distance <= 1)
        if found.any():
            yield q[found], lo[found]
        own = lambda i: letters[at[q] + np.clip(i, 0, size[q])]
        new_left = np.minimum(mid + 1, left + (own(d - 1) != letter))
        new_mid = np.minimum(np.minimum(mid + (own(d) != letter), new_left + 1), right + 1)
        new_right = np.minimum(right + (own(d + 1) != letter), new_mid + 1)
        alive = ~ended & (np.minimum(np.minimum(new_left, new_mid), new_right) <= 1)
        if alive.any():
            cells = (np.minimum(x[alive], 2).astype(np.int8) for x in (new_left, new_mid, new_right))
            fronts.append((d + 1, q[alive], lo[alive], hi[alive], *cells))


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of whole units, of about ``BATCH_LETTERS`` code points together, as tuples in order."""
    held, letters = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if letters > BATCH_LETTERS and row[0] != held[-1][0]:
                yield held
                held, letters = [], 0
            held.append(row)
            letters += len(row[1]) + 1
    if held:
        yield held


def near_words(units: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of each unit's words with a near word there; the best is the most frequent one
    (ties: smallest).  A pair is counted in one unit only."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def task(batches):
        for rows in _unit_batches(batches):
            names, rests, half, turned, words, counts, own, across = (list(c) for c in zip(*rows))
            names = np.array(names, object)
            unit = np.cumsum(np.append(False, names[1:] != names[:-1]))
            pairs = list(near_pairs(rests, unit))
            if not pairs:
                continue
            i, j = (np.concatenate(x) for x in zip(*pairs))
            length, half, turned = np.fromiter(map(len, words), np.int64), np.array(half), np.array(turned)
            own, across, counts = np.array(own), np.array(across), np.array(counts, np.int64)
            # One unit for a pair: by the shorter word's length, by first half if they share it, by blocks.
            here = (np.minimum(length[i], length[j]) >> 1 == half[i]) & (~across[i] | (own[i] != own[j]))
            here &= [not t or words[a][:h] != words[b][:h] for t, h, a, b in zip(turned[i], half[i], i, j)]
            i, j = np.concatenate([i[here], j[here]]), np.concatenate([j[here], i[here]])
            rank = np.empty(len(words), np.int64)
            rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
            order = np.lexsort((rank[j], -counts[j], i))
            i, j = i[order], j[order]
            found, first, n = np.unique(i, return_index=True, return_counts=True)
            if len(found):
                best = j[first]
                yield record(schema, [words[k] for k in found], n, counts[best], [words[k] for k in best])

    return units.mapInArrow(task, "word string, n_near long, best_n long, best string")


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)`` without cycles: the last word on the way from form to form.

    Pointers are doubled, so the rounds grow with the logarithm of the longest way; each is written to the shared folder."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        above = links.select(F.col("word").alias("root"), F.col("root").alias("above"))
        links, seen = materialize_observed(
            links.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.isnotnull("above").alias("moved")),
            [F.count_if("moved").alias("moved")], "roots")
        links = links.drop("moved")
        if not seen["moved"]:
            return links


def spelling_groups(docs: DataFrame, min_length: int = 5, min_count: int = 3, drop_every: int | None = None,
                    factor: int = 2, block: int = BLOCK) -> DataFrame:
    """One row per word of the vocabulary: ``word, n, n_near, form, form_n, root``.

    Two words are near if one inserted, deleted or replaced code point makes one the other; ``n_near`` counts a
    word's near words.  ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order) if that is
    ``factor`` times the word's own or more, else null, as is ``form_n``.  ``root`` is the end of the way from form to form, the
    word itself without a form.

    Null and empty texts have no words; rows of a null id count, undamaged by ``drop_every``; repeated rows count
    each time; an empty table gives no rows; other columns are not read.  Words may be of any length."""
    vocab = materialize(vocabulary(docs, min_length, min_count, drop_every), "vocabulary")
    near = near_words(in_lists(vocab, block)).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best"))).alias("top"))
    has_form = -F.col("top.n") >= factor * F.col("n")
    out = materialize(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("top.best")).alias("form"), F.when(has_form, -F.col("top.n")).alias("form_n")), "near_words")
    roots = follow(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


#: The same for the registered query, in DuckDB SQL: near words meet by what is left after one deletion.
ORACLE_SQL = f"""
WITH RECURSIVE table_of AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(trim(regexp_replace(hex(encode(doc_id || ':' || run)), '(..)', '\\1 ', 'g')), ' '), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM pairs, table_of),
thinned AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
            FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS form FROM near GROUP BY word),
formed AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * words.n THEN form END AS form,
                  CASE WHEN top >= 2 * words.n THEN top END AS form_n FROM words LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root FROM formed UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON way.root = formed.word WHERE form IS NOT NULL),
ends AS (SELECT way.word, root FROM way JOIN formed ON way.root = formed.word WHERE form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)
"""
