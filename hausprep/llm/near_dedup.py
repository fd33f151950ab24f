"""Near-duplicate classes by improved consistent weighted sampling (operator 7).

A document is the weighted set of its shingles (five consecutive words); a
shingle weighs its count times an inverse document frequency.  The samples of
Ioffe's improved consistent weighted sampling agree between two documents with
the probability of their weighted Jaccard similarity.  The work goes:

1. one pass counts shingles by hash bucket (a table of fixed size, summed by
   Spark over all documents), from which the idf is read;
2. a second pass draws ``BANDS * ROWS`` samples per document; documents with
   the same words meet by their fingerprint, and one of them goes on;
3. documents that share a band's samples and agree in a good part of all samples
   are candidates; a group's candidates are joined by a spanning forest, so a group
   of ``n`` gives at most ``n - 1`` rows;
4. within the components of candidates, the exact weighted Jaccard similarity
   decides; the components of the verified links are the classes.

Groups are worked on in blocks: one of more than ``BLOCK`` members is cut into
blocks by hash, and every pair of blocks is a unit of work of its own.  No group
is therefore held by one task, no member is dropped, and no pair is emitted that
is not a link of a forest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import fresh_name, in_pieces, record, words_of
from hausprep.llm.components import connected_components
from hausprep.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
BUCKETS_BITS = 18          # shingles are counted in 2 ** 18 hash buckets
BLOCK = 1024               # members of a unit of work, of each of its two blocks
LEAST_AGREEMENT = 0.6      # of the samples of two candidates (five deviations below 0.8, seven-tenths of one aside)
_TABLE_BITS = 16
_SEED = 20_017
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a sum depend on all its parts."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_WORDS = _WordHashes()


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and their counts; none for fewer than five words."""
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    total = h[:n].copy()
    for k in range(1, SHINGLE):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    return np.unique(mix(total), return_counts=True)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS_BITS)).astype(np.int64)


def idf_table(docs: DataFrame) -> np.ndarray:
    """Idf by bucket, from 1 (in every document) to 2: ``1 + ln((1 + N) / (1 + df)) / ln(1 + N)``.

    ``df`` is the number of distinct shingles of documents in the bucket, ``N`` that of documents with a shingle.
    The driver gets one number per bucket, however many documents there are.
    """
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def task(batches):
        counts, n = np.zeros(1 << BUCKETS_BITS, np.int64), 0
        for batch in batches:
            for _, texts in in_pieces(batch):
                found = [shingles(words_of(t))[0] for t in texts]
                n += sum(len(f) > 0 for f in found)
                counts += np.bincount(bucket(np.concatenate(found)), minlength=1 << BUCKETS_BITS)
        at = np.flatnonzero(counts)
        yield record(schema, np.append(at, -1), np.append(counts[at], n))

    counts = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(task, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = counts.column("bucket").to_numpy(), counts.column("n").to_numpy()
    df = np.zeros(1 << BUCKETS_BITS)
    df[at[at >= 0]] = n[at >= 0]
    total = max(1, int(n[at < 0].sum()))
    return np.clip(1 + np.log((1 + total) / (1 + df)) / np.log(1 + total), 1, 2).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling; the random numbers of a shingle are drawn from tables by hash."""

    def __init__(self, samples: int, seed: int = _SEED):
        rng = np.random.default_rng(seed)
        size = 1 << _TABLE_BITS
        self.r = rng.standard_gamma(2.0, size).astype(np.float32)
        self.log_c = np.log(rng.standard_gamma(2.0, size)).astype(np.float32)
        self.beta = rng.random(size).astype(np.float32)
        self.odd = rng.integers(0, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Samples (as 32-bit hashes of shingle and level) of the documents that begin at ``starts``, none empty."""
        log_w = np.log(weights.astype(np.float32))
        n = np.diff(np.append(starts, len(hashes)))
        owner = np.repeat(np.arange(len(starts)), n)
        out = np.empty((len(starts), len(self.odd)), np.uint32)
        for k, odd in enumerate(self.odd):
            at = (hashes * odd) >> np.uint64(64 - _TABLE_BITS)
            r, beta = self.r[at], self.beta[at]
            level = np.floor(log_w / r + beta)
            log_a = self.log_c[at] - r * (level - beta + 1)
            least = np.minimum.reduceat(log_a, starts)
            found = np.flatnonzero(log_a == least[owner])
            first = found[np.unique(owner[found], return_index=True)[1]]
            out[:, k] = mix(hashes[first] + level[first].astype(np.int64).astype(np.uint64) * odd).astype(np.uint32)
        return out


_SAMPLERS: dict[int, Sampler] = {}


def sampler(samples: int) -> Sampler:
    if samples not in _SAMPLERS:
        _SAMPLERS[samples] = Sampler(samples)
    return _SAMPLERS[samples]


def band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each document."""
    rows = samples.shape[1] // bands
    parts = samples.reshape(len(samples), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """``id, text_hash, words, sample, keys`` for ``docs(id, text)``.

    ``words`` is a 128-bit digest of all words (null without words); ``sample`` and ``keys`` are null for
    fewer than five words."""
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("words", pa.binary()),
                        ("sample", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def task(batches):
        draw = sampler(bands * rows)
        for batch in batches:
            for part, texts in in_pieces(batch):
                words = [words_of(t) for t in texts]
                digests = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None for w in words]
                found = [shingles(w) for w in words]
                full = [i for i, (h, _) in enumerate(found) if len(h)]
                samples: list = [None] * len(texts)
                keys: list = [None] * len(texts)
                if full:
                    hashes = np.concatenate([found[i][0] for i in full])
                    weights = np.concatenate([found[i][1] for i in full]) * idf.value[bucket(hashes)]
                    starts = np.cumsum([0] + [len(found[i][0]) for i in full[:-1]])
                    drawn = draw(hashes, weights, starts)
                    for i, s, k in zip(full, drawn, band_keys(drawn, bands).tolist()):
                        samples[i], keys[i] = s.tobytes(), k
                yield record(schema, part.column("id"), part.column("text_hash"), digests, samples, keys)

    return docs.select("id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        task, "id long, text_hash long, words binary, sample binary, keys array<long>")


def in_blocks(members: DataFrame, key: str, n: str, block: int) -> DataFrame:
    """Members of groups of ``n``, once for each pair of blocks they are in: ``unit``, the group and the two blocks.
    All rows of a unit come one after the other within one partition."""
    blocks = F.ceil(F.col(n) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = members.withColumn("own", own).withColumn("other", other)
    unit = F.struct(F.col(key).alias("group"), F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    rows = rows.withColumn("unit", F.to_json(unit)).drop("own", "other", key, n)
    return rows.repartition("unit").sortWithinPartitions("unit", "id")


def by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each unit as one table, from sorted batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        units = batch.column("unit").to_pylist()
        start = 0
        for i in range(len(units) + 1):
            if i == len(units) or units[i] != units[start]:
                if i == start:
                    continue
                if units[start] != current and held:
                    yield pa.Table.from_batches(held)
                    held = []
                current = units[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield pa.Table.from_batches(held)


def forest(n: int, alike: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph in which ``alike(i, others)`` tells the neighbours of ``i``."""
    links, left = [], np.arange(n)
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = alike(i, left)
            links += [(i, int(j)) for j in left[near]]
            queue += left[near].tolist()
            left = left[~near]
    return links


def candidate_links(members: DataFrame, least: float) -> DataFrame:
    """``a, b``: a forest of those members of each unit that agree in ``least`` of their samples."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches):
        for rows in by_unit(batches):
            if rows.num_rows < 2:
                continue
            ids = rows.column("id").to_pylist()
            samples = np.frombuffer(b"".join(rows.column("sample").to_pylist()), np.uint32).reshape(len(ids), -1)
            links = forest(len(ids), lambda i, others: (samples[others] == samples[i]).mean(1) >= least)
            links = [(ids[i], ids[j]) for i, j in links if ids[i] != ids[j]]
            if links:
                yield record(schema, *zip(*links))

    return members.select("unit", "id", "sample").mapInArrow(task, "a long, b long")


def weighted_jaccard(features: list[tuple[np.ndarray, np.ndarray]]) -> Callable[[int, np.ndarray], np.ndarray]:
    """``f(i, others)``: exact similarities of document ``i`` with others, for ``(hashes, weights)`` of each."""
    sizes = np.array([len(h) for h, _ in features])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    universe, at = np.unique(np.concatenate([h for h, _ in features]), return_inverse=True)
    weights = np.concatenate([w for _, w in features]).astype(np.float64)
    totals = np.array([w.sum() for _, w in features], np.float64)
    own = np.zeros(len(universe))

    def similarity(i: int, others: np.ndarray) -> np.ndarray:
        mine = slice(starts[i], starts[i + 1])
        own[at[mine]] = weights[mine]
        out = np.zeros(len(others))
        # The similarity is at most the ratio of the totals.
        full = np.flatnonzero((sizes[others] > 0) & (np.minimum(totals[others], totals[i])
                                                     >= 0.5 * np.maximum(totals[others], totals[i])))
        if sizes[i] and len(full):
            n = sizes[others[full]]
            first = np.cumsum(n) - n
            index = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(starts[others[full]], n)
            common = np.add.reduceat(np.minimum(own[at[index]], weights[index]), first)
            out[full] = common / (totals[others[full]] + totals[i] - common)
        own[at[mine]] = 0
        return out

    return similarity


def verified_links(members: DataFrame, idf, least: float) -> DataFrame:
    """``a, b``: a forest of those members of each unit whose weighted Jaccard similarity is ``least`` or more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches):
        for rows in by_unit(batches):
            if rows.num_rows < 2:
                continue
            ids = rows.column("id").to_pylist()
            found = [shingles(words_of(t or "")) for t in rows.column("text").to_pylist()]
            same = weighted_jaccard([(h, c * idf.value[bucket(h)]) for h, c in found])
            links = forest(len(ids), lambda i, others: same(i, others) >= least - 1e-9)
            links = [(ids[i], ids[j]) for i, j in links if ids[i] != ids[j]]
            if links:
                yield record(schema, *zip(*links))

    return members.select("unit", "id", "text").mapInArrow(task, "a long, b long")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
            block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, copy_of, text_hash``.

    ``class_id`` is the least id of the near-duplicate class, ``copy_of`` the least id with the same words.
    Texts of fewer than five words are only in a class with copies; texts without words, null ones included,
    and rows with a null id (whose class is null) are in none but their own.  Rows that share an id are one
    document whose texts may each be near others.  Ties need no rule: ids alone decide.  Other columns
    are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
    named = texts.where(F.col("id").isNotNull())
    idf = spark.sparkContext.broadcast(idf_table(named))
    signed = materialize(signatures(named, idf, bands, rows), "signatures")

    copies = materialize(signed.where(F.col("words").isNotNull()).groupBy("words").agg(F.min("id").alias("copy_of")), "copies")
    nodes = signed.where(F.col("sample").isNotNull()).join(
        copies.withColumnRenamed("copy_of", "id"), ["words", "id"])          # spread by words and id
    banded = nodes.select("id", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = banded.join(shared, "key").join(nodes.select("id", "sample"), "id")
    candidates = connected_components(candidate_links(in_blocks(members, "key", "n", block), LEAST_AGREEMENT))
    candidates = candidates.join(candidates.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "root")
    # Joined by sorting at every size: whether the few columns of the candidates can be broadcast depends on the corpus.
    members = named.where(F.col("text").isNotNull()).join(candidates.hint("merge"), "id")
    # Rows of one id may hold a text that is a mere copy; it is compared like any other.
    links = verified_links(in_blocks(members, "root", "n", block), idf, similarity)
    found = connected_components(links).withColumnsRenamed({"id": "copy_of", "root": "class_id"})

    out = signed.select("id", "text_hash", "words").join(copies, "words", "left").join(found, "copy_of", "left")
    out = out.select(F.col("id").alias("doc_id"), F.coalesce("class_id", "copy_of", "id").alias("class_id"),
                     F.coalesce("copy_of", "id").alias("copy_of"), "text_hash")
    unnamed = texts.where(F.col("id").isNull()).select(
        F.col("id").alias("doc_id"), F.col("id").alias("class_id"), F.col("id").alias("copy_of"), F.xxhash64("text").alias("text_hash"))
    return out.unionByName(unnamed)


def dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id.

    Of rows that repeat both id and text one stays.  Rows that share an id but hold different texts are no near duplicates
    for that: a text goes only if it is in a class with a smaller id.  Rows of a null id stay."""
    found = classes(docs, similarity)
    key, hashed = fresh_name(docs, "near_id__"), fresh_name(docs, "near_hash__")
    extra = found.where("doc_id <> class_id").select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed)).distinct()
    own_id, text_hash = docs["doc_id"].cast("long"), F.xxhash64(docs["text"])
    kept = docs.join(extra.hint("merge"), (own_id == F.col(key)) & (text_hash == F.col(hashed)), "left_anti")
    again = found.where("doc_id = class_id").groupBy("doc_id", "text_hash").count().where("count > 1")
    if again.isEmpty():
        return kept
    named = kept.where(docs["doc_id"].isNotNull()).withColumns({key: own_id, hashed: text_hash})
    return named.dropDuplicates([key, hashed]).drop(key, hashed).unionByName(kept.where(docs["doc_id"].isNull()))
