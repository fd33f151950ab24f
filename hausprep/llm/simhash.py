"""SimHash groups found by pivot distance tables (operator 12).

A text's fingerprint has 64 bits: a bit is set if it is set in more than half of
the hashes (XXH64, seed 42) of its shingles of three words.  Fingerprints link at
``RADIUS`` or fewer differing bits; the components of the links are the groups.

The distances to many reference fingerprints (the pivots) are worked out first.
If two fingerprints differ in two bits, their distances to any pivot differ by
two at most, so a pair with a larger difference in any coordinate of the
table is discarded; what is left is verified bit by bit.

The same table tells Spark which fingerprints must meet.  Among the pivots are zero
and ``BLOCKS`` masks, one for each block of adjacent bits; the distance to a mask less
that to zero changes only if a bit of this block does, so at most two of the ``BLOCKS``
differences change.  Of ``PARTS`` equal parts of the blocks, two at least stay as they
are: fingerprints meet under the differences of two parts, one key for each pair of
parts.  A fingerprint is sent once per key, whatever the corpus holds; those under one key
are cut into blocks if many, and give a forest of links, never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import in_pieces, lookup, record
from hausprep.llm.components import connected_components
from hausprep.llm.near_dedup import forest
from hausprep.session import materialize

SHINGLE, SEED = 3, 42
RADIUS = 2
BLOCK = 1024               # members of a unit of work, of each of its two blocks
BLOCKS, PARTS = 32, 4      # blocks of two bits each; parts of eight blocks each
TEXT_BYTES = 1 << 20       # of a long text that are split into words at once
_SPACE = b" \t\n\r\x0b\x0c"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Zero and a mask for each block, then pivots of random bits.
MASKS = [((1 << 64 // BLOCKS) - 1) << (64 // BLOCKS * k) for k in range(BLOCKS)]
PIVOTS = np.concatenate([np.array([0, *MASKS], np.uint64),
                         np.random.default_rng(12).integers(0, 1 << 64, 63 - BLOCKS, np.uint64)])

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``TEXT_BYTES`` at a time."""
    start = 0
    while start < len(text):
        end = start + TEXT_BYTES
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[start:end].split()
        start = end


def hashes(text: str) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles in order; of all its words if they are fewer; of nothing without words."""
    carried: list[bytes] = []
    any_found = False
    for words in word_runs(text.encode("utf-8", "surrogatepass").translate(_LOWER)):
        words = carried + words
        if len(words) >= SHINGLE:
            any_found = True
            whole = zip(*(words[k:] for k in range(SHINGLE)))
            yield np.fromiter(map(_hash, map(b" ".join, whole)), np.uint64, len(words) - SHINGLE + 1)
        carried = words[1 - SHINGLE:]
    if carried and not any_found:
        yield np.array([_hash(b" ".join(carried))], np.uint64)


def set_bits(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the lowest first."""
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: str) -> int:
    """The SimHash as a signed 64-bit number; zero for a text without words."""
    n, bits = 0, np.zeros(64, np.int64)
    for h in hashes(text):
        n += len(h)
        bits += set_bits(h)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, bits`` for ``docs(doc_id, text)``; a null text is an empty one."""
    schema = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])

    def task(batches):
        for batch in batches:
            for part, texts in in_pieces(batch):
                yield record(schema, part.column("doc_id"), [fingerprint(t) for t in texts])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(task, "doc_id long, bits long")


def meeting_keys(bits: Column) -> Column:
    """A key for each pair of parts: which pair, and how the distances to the masks of its blocks differ from that to zero."""
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    differences = [(F.bit_count(bits.bitwiseXOR(F.lit(signed(m)).cast("long"))) - F.bit_count(bits) + 2) / 2 for m in MASKS]
    per = BLOCKS // PARTS
    parts = [sum((d.cast("long") * 3 ** k for k, d in enumerate(differences[p * per:(p + 1) * per])), F.lit(0).cast("long"))
             for p in range(PARTS)]
    return F.array(*[F.lit(i).cast("long") + 16 * (parts[a] * 3 ** per + parts[b]) for i, (a, b) in enumerate(combinations(range(PARTS), 2))])


def in_units(nodes: DataFrame, block: int) -> DataFrame:
    """``unit, bits, own, across`` for ``nodes(bits)``: the fingerprints under each shared key, for each pair of blocks."""
    keyed = materialize(nodes.select("bits", meeting_keys(F.col("bits")).alias("keys")).select("bits", F.explode("keys").alias("key")), "keyed")
    sizes = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key_sizes")
    rows = lookup(keyed, sizes, "key", "n", how="inner")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("bits"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    one, two = F.least("own", "other"), F.greatest("own", "other")
    return rows.select(F.struct("key", one.alias("one"), two.alias("two")).alias("unit"), "bits") \
        .repartition("unit").sortWithinPartitions("unit", "bits")


def distance_table(bits: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to the pivots, a row each."""
    return np.bitwise_count(bits[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def linked(bits: np.ndarray):
    """``f(i, others)``: which of the others link with ``i``, by the distance table and then bit by bit."""
    table = distance_table(bits)

    def alike(i: int, others: np.ndarray) -> np.ndarray:
        left = np.arange(len(others))
        for some in (slice(0, 8), slice(8, None)):         # most pairs fall by the first coordinates
            left = left[np.abs(table[others[left], some] - table[i, some]).max(1) <= RADIUS]
        out = np.zeros(len(others), bool)
        out[left] = np.bitwise_count(bits[others[left]] ^ bits[i]) <= RADIUS
        return out

    return alike


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints of whole units and where each unit begins, some thousands of rows together."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        unit = np.stack([c.to_numpy() for c in batch.column("unit").flatten()], 1)
        held.append((unit, batch.column("bits").to_numpy().view(np.uint64)))
        unit, bits = (np.concatenate(x) for x in zip(*held))
        starts = np.flatnonzero(np.append(True, (unit[1:] != unit[:-1]).any(1)))
        held = [(unit[starts[-1]:], bits[starts[-1]:])]      # the last unit may go on
        if len(starts) > 1:
            yield bits[:starts[-1]], starts[:-1]
    if held and len(held[0][1]):
        yield held[0][1], np.zeros(1, np.int64)


def links(units: DataFrame) -> DataFrame:
    """``a, b``: a forest of the linked fingerprints of each unit."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def task(batches):
        for bits, starts in _units(batches):
            n = np.diff(np.append(starts, len(bits)))
            pairs = starts[n == 2]                              # most units: no forest needed
            table = distance_table(bits)
            near = np.abs(table[pairs] - table[pairs + 1]).max(1) <= RADIUS
            pairs = pairs[near]
            pairs = pairs[np.bitwise_count(bits[pairs] ^ bits[pairs + 1]) <= RADIUS]
            found = [(pairs, pairs + 1)]
            for start, size in zip(starts[n > 2].tolist(), n[n > 2].tolist()):
                tree = forest(size, linked(bits[start:start + size]))
                if tree:
                    found.append(tuple(np.array(x) + start for x in zip(*tree)))
            a, b = (bits[np.concatenate(x)].view(np.int64) for x in zip(*found))
            if len(a):
                yield record(schema, a, b)

    return units.mapInArrow(task, "a long, b long")


def simhash_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the least doc_id of the component of links, the
    document's own included.  Null and empty texts have fingerprint zero and link like any other.  Rows of a null
    id take part and may connect others, but are never the least (null if a component has no id at all).  Repeated rows
    and ids are kept, each a row; ties need no rule; an empty table gives no rows; other columns are not read."""
    signed = materialize(fingerprints(docs), "fingerprints")
    nodes = materialize(signed.groupBy("bits").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(links(in_units(nodes.select("bits"), block))).withColumnsRenamed({"id": "bits"})
    linked = materialize(nodes.join(roots, "bits"), "linked")
    groups = linked.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.min("least").alias("component_id"))
    linked = lookup(linked, materialize(groups, "groups"), "root", "members")
    alone = nodes.join(roots, "bits", "left_anti").withColumnRenamed("least", "component_id")
    found = materialize(linked.select("bits", "n", "component_id").unionByName(alone.select("bits", "n", "component_id")), "components")
    out = lookup(signed, found, "bits", "n")
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
