"""Benchmark decontamination by a generalised suffix automaton (operator 1).

The normalised test items go into one automaton over words.  Each document's
words are streamed through it; the state and the length of the longest match
that ends at a word tell whether a window of an item ends there: a match of
``window`` words or more, or, for an item shorter than a window, the whole
item.  Both are read off the state's suffix links.

The test set is cut into blocks of items of a bounded size; one automaton
is built and broadcast per block, and the documents are streamed once for each
block.  Usual test sets are one block.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import LOWER, WORD, fresh_name, in_pieces, pick, words_of

WINDOW = 10
BLOCK_BYTES = 4 << 20       # text of the items of one automaton


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the windows' items by state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.words.setdefault(w, len(self.words)))
        self.shortest = min([min(len(w), window) for _, w in items if w], default=window)
        self._find_windows(items)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, word, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _find_windows(self, items) -> None:
        """For each state: the windows that are suffixes of its words, as (words, items), longest first."""
        here: dict[tuple[int, int], set] = {}       # (state, words) -> items with that window
        for k, (item_id, words) in enumerate(items):
            size = min(len(words), self.window)
            s, n = 0, 0
            for w in words:
                s, n = self.next[s][self.words[w]], n + 1
                while self.length[self.link[s]] >= size:      # the state that holds the last `size` words
                    s, n = self.link[s], self.length[self.link[s]]
                if n >= size:
                    n = size
                    here.setdefault((s, size), set()).add(item_id)
        at: dict[int, list] = {}
        for (s, size), ids in here.items():
            at.setdefault(s, []).append((size, frozenset(i for i in ids if i is not None)))
        self.found: list[tuple] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            own = tuple(sorted(at.get(s, ()), key=lambda x: -x[0]))
            self.found[s] = own + self.found[self.link[s]]

    def spans(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Word spans ``[first, end)`` covered by windows, merged and in order, and the items hit.

        The automaton reads the runs of words that occur in items; a run shorter than the shortest
        window cannot hold one."""
        spans: list[list[int]] = []
        items: set = set()
        if len(words) < self.shortest:
            return spans, items
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(ids < 0)
        starts, ends = np.append(0, unknown + 1), np.append(unknown, len(ids))
        for k in np.flatnonzero(ends - starts >= self.shortest).tolist():
            first = int(starts[k])
            self._read(ids[first:ends[k]].tolist(), first, spans, items)
        return spans, items

    def _read(self, ids: list[int], at: int, spans: list[list[int]], items: set) -> None:
        nxt, link, length, found, cap = self.next, self.link, self.length, self.found, self.window
        s = n = 0
        for i, w in enumerate(ids, at):
            to = nxt[s].get(w)
            while to is None:                        # every known word leaves the first state
                s = link[s]
                n = length[s]
                to = nxt[s].get(w)
            s, n = to, n + 1
            if n > cap:                              # longer matches tell nothing more
                n = cap
                while length[link[s]] >= n:
                    s = link[s]
            for size, names in found[s]:
                if size <= n:
                    items |= names
                    first = i + 1 - size
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append([first, i + 1])


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[list[tuple]]:
    """Items by block; yields one block at a time, so that the driver holds no more than one."""
    items = pick(benchmark, "item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = int(-(-total // block_bytes)) or 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(None if i is None else str(i), words_of(t)) for i, t in part.collect()]


def automata_of(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """One broadcast automaton per block of items."""
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(SuffixAutomaton(block, window)) for block in blocks_of(benchmark, block_bytes)]


def hits_of(automata: list, text: str) -> tuple[int, list[list[int]], set]:
    """Number of words, merged spans inside windows, and ids of the items hit."""
    words = words_of(text)
    spans: list[list[int]] = []
    items: set = set()
    for a in automata:
        more, ids = a.value.spans(words)
        spans += more
        items |= ids
    return len(words), merged(spans) if len(automata) > 1 else spans, items


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``hit``: ``struct<n_words long, spans array<array<long>>, items array<string>>``.

    A window is ``window`` consecutive words of an item, or the whole of a shorter one; spans are the words
    inside occurrences, ``[first, end)``, merged.  Null or empty texts have no words.  Items without words
    (or null) have no window; windows of items with a null id count as hits but name no item; equal items
    are one window with several names.  An empty benchmark hits nothing.  If ``docs`` has a column ``hit``,
    the new one is called ``hit_`` (and so on).
    """
    hit = fresh_name(docs, "hit")
    automata = automata_of(benchmark, window, block_bytes)
    source = docs.withColumn(hit, F.lit(None).cast("struct<n_words:long,spans:array<array<long>>,items:array<string>>"))

    def task(batches):
        for batch in batches:
            for part, texts in in_pieces(batch):
                hits = []
                for t in texts:
                    n_words, spans, items = hits_of(automata, t)
                    hits.append({"n_words": n_words, "spans": spans, "items": sorted(items)})
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                kind = part.schema.field(part.num_columns - 1).type
                yield pa.RecordBatch.from_arrays([*columns, pa.array(hits, kind)], schema=part.schema)

    return source.mapInArrow(task, source.schema)


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and out[-1][1] >= first:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and the
    spans as ``hit_spans``.  Edge cases as in :func:`find_passages`."""
    found = find_passages(pick(docs, "doc_id", "text"), benchmark, window)
    hit = found["hit"]
    n_hit = F.aggregate(hit["spans"], F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), hit["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hit["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(hit["spans"]) > 0).alias("contaminated"), hit["spans"].alias("hit_spans"))


def cut_passages(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text.lower() if text.isascii() else text.translate(LOWER))]
    out, done = [], 0
    for first, end in spans:
        out.append(text[done:at[first][0]])
        done = at[end - 1][1]
    return "".join(out) + text[done:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = 0.2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without benchmark passages, in the same columns.

    Matched spans (of ``window`` words or more, or whole shorter items) are cut out of the text; a document
    of whose words more than ``max_coverage`` lie in such spans goes altogether.  Documents without a match,
    with null or empty text included, stay as they are.
    """
    automata = automata_of(benchmark, window, block_bytes)
    columns, schema = docs.columns, docs.schema
    at = columns.index("text")

    # One pass, not a search and then a cut: each step of its own would hold a Python worker more per core.
    def task(batches):
        for batch in batches:
            for part, texts in in_pieces(batch):
                cut, keep = [], []
                for t, null in zip(texts, part.column(at).is_null().to_pylist()):
                    n_words, spans, _ = hits_of(automata, t)
                    keep.append(sum(end - first for first, end in spans) <= max_coverage * n_words)
                    cut.append(None if null else cut_passages(t, spans) if spans else t)
                arrays = [part.column(i) for i in range(len(columns))]
                arrays[at] = pa.array(cut, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(task, schema)
