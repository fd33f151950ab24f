"""Language identification by hyperdimensional profiles (operator 5).

Every letter (and the gap between words) has a random vector of +1 and -1.  A
trigram's vector binds its letters' vectors, each rotated by its place, by
multiplication; a text's vector bundles (adds) those of its trigrams.  A
language's prototype bundles the trigrams of all its training documents; a
document takes the language of the prototype with the highest cosine.

Training sends one integer vector per language and task into a Spark sum, so
the prototypes cover all training documents exactly and their size does not
depend on the number of documents.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import fresh_name, in_pieces, pick, record

DIMENSIONS = 1024
SEED = 20_011
_SLOTS = 2048           # letters below U+0400 have a slot each, others share the rest by hash
_SHIFT = 11


class Encoder:
    """Hypervectors of trigrams."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        letters = np.random.default_rng(seed).integers(0, 2, (_SLOTS, dimensions), np.int8) * np.int8(2) - np.int8(1)
        self.places = [np.roll(letters, k, axis=1) for k in (2, 1, 0)]
        points = np.arange(0x110000, dtype=np.uint64)
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        slots = np.where(points < 1024, points, 1024 + ((points * 2654435761) >> np.uint64(15)) % 1024)
        self.slots = np.where(alpha, slots, 0).astype(np.int16)

    def trigrams(self, texts: list[str]) -> list[np.ndarray]:
        """Trigram codes of each text; a gap (code 0) stands for any run of non-letters and at both ends."""
        lowered = ["\n" + t.lower() + "\n" for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        slots = self.slots[points].astype(np.int64)
        first = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
        keep = slots > 0
        keep[1:] |= slots[:-1] > 0                  # one gap after each word
        keep[first[:-1]] = True                     # and one before the text
        at = np.cumsum(keep)
        bounds = np.concatenate([[0], at[first[1:] - 1]])
        s = slots[keep]
        codes = (s[:-2] << (2 * _SHIFT)) | (s[1:-1] << _SHIFT) | s[2:]
        return [codes[a:max(a, b - 2)] for a, b in zip(bounds[:-1], bounds[1:])]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """Bound vectors, one byte an entry; made in blocks, so that temporaries stay small."""
        out = np.empty((len(codes), self.places[0].shape[1]), np.int8)
        for i in range(0, len(codes), 1024):
            part = codes[i:i + 1024]
            a, b, c = part >> (2 * _SHIFT), (part >> _SHIFT) & (_SLOTS - 1), part & (_SLOTS - 1)
            np.multiply(self.places[0][a], self.places[1][b], out=out[i:i + 1024])
            out[i:i + 1024] *= self.places[2][c]
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Exact integer sum of the trigrams' vectors."""
        out = np.zeros(self.places[0].shape[1], np.int64)
        for i in range(0, len(codes), 1024):
            v = self.vectors(codes[i:i + 1024]).astype(np.float64)
            out += (counts[i:i + 1024].astype(np.float64) @ v).astype(np.int64)
        return out


def bundled(counts: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of those rows of ``vectors``, each as often as it occurs."""
    return sum(counts[i:i + 4096].astype(np.float32) @ vectors[rows[i:i + 4096]].astype(np.float32)
               for i in range(0, len(rows), 4096))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(dimensions: int, seed: int) -> Encoder:
    if (dimensions, seed) not in _ENCODERS:
        _ENCODERS[dimensions, seed] = Encoder(dimensions, seed)
    return _ENCODERS[dimensions, seed]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def learn_profiles(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Unit prototype of every non-null ``lang`` that has a letter in its texts.

    The driver gets ``dimensions`` numbers for each language, however many documents there are.
    """
    schema = pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.int64()))])

    def task(batches):
        enc = encoder(dimensions, seed)
        seen: dict[str, list] = defaultdict(list)
        for batch in batches:
            for part, texts in in_pieces(batch):
                by_lang: dict[str, list] = defaultdict(list)
                for lang, codes in zip(part.column("lang").to_pylist(), enc.trigrams(texts)):
                    by_lang[lang].append(codes)
                for lang, codes in by_lang.items():
                    codes = np.concatenate(codes)
                    codes = codes[codes > 0]
                    if len(codes):
                        seen[lang].append(np.unique(codes, return_counts=True))
                        if len(seen[lang]) > 40:
                            seen[lang] = [_merged(seen[lang])]
        for lang, parts in seen.items():
            yield record(schema, [lang], [enc.bundle(*_merged(parts)).tolist()])

    parts = pick(docs, "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .mapInArrow(task, "lang string, vector array<long>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "part")) \
        .groupBy("lang", "at").agg(F.sum("part").alias("total"))
    found: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions))
    for lang, at, total in sums.collect():
        found[lang][at] = total
    return {k: v / np.linalg.norm(v) for k, v in sorted(found.items()) if np.any(v)}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], columns: list[Column],
             dimensions: int = DIMENSIONS, seed: int = SEED, pred: str = "lang_pred", score: str = "score",
             trigrams: str | None = None) -> DataFrame:
    """``columns`` of ``docs`` with ``lang_pred`` and ``score`` (or as named), the cosine of the nearest
    prototype (0 at least); ``trigrams`` names a column to add with the text's number of trigrams.

    A null text, one without a letter, or any text if nothing was learned, is ``und`` with score 0.
    Ties go to the first language by name.
    """
    names = list(profiles)
    matrix = np.array([profiles[n] for n in names], np.float32).reshape(len(names), dimensions)
    held = docs.sparkSession.sparkContext.broadcast(matrix)
    source = docs.select(*columns, docs["text"].alias(fresh_name(docs, "read__")))
    read = source.columns[-1]
    out = source.drop(read).withColumns({pred: F.lit(None).cast("string"), score: F.lit(None).cast("double")})
    out = (out.withColumn(trigrams, F.lit(None).cast("long")) if trigrams else out).schema

    def task(batches):
        enc = encoder(dimensions, seed)
        for batch in batches:
            for part, texts in in_pieces(batch, read):
                languages, cosines = [], []
                grams = [np.unique(c, return_counts=True) for c in enc.trigrams(texts)]
                codes, at = np.unique(np.concatenate([c for c, _ in grams]), return_inverse=True)
                vectors = enc.vectors(codes)
                bounds = np.concatenate([[0], np.cumsum([len(c) for c, _ in grams])])
                for k, (own, counts) in enumerate(grams):
                    best, cosine = -1, 0.0
                    if len(names) and len(own) and own[-1] > 0:
                        v = bundled(counts, vectors, at[bounds[k]:bounds[k + 1]])
                        norm = float(np.linalg.norm(v))
                        if norm:
                            near = held.value @ v / norm
                            best = int(np.argmax(near))
                            cosine = min(1.0, max(0.0, float(near[best])))
                    languages.append(names[best] if best >= 0 else "und")
                    cosines.append(cosine)
                numbers = [pa.array([int(n.sum()) for _, n in grams], pa.int64())] if trigrams else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(languages, pa.string()), pa.array(cosines, pa.float64()), *numbers],
                    names=out.names)

    return source.mapInArrow(task, out)


def reject_unknown(docs: DataFrame, min_score: float = 0.2, min_chars: int = 200, full_trigrams: int = 120,
                   least_trigrams: int = 10) -> DataFrame:
    """``docs`` without those in no known language, in the same columns.

    Profiles are learned from all documents with a ``lang``.  Rejected are texts that are null or have no
    letter, and texts whose cosine to every profile is below a floor: ``min_score`` for texts of ``min_chars`` or
    ``full_trigrams`` or more, for shorter ones in proportion to their trigrams.  Only texts of less than
    ``least_trigrams`` trigrams, a word or two, have none: there the cosine tells nothing.
    """
    pred, score, trigrams = (fresh_name(docs, c) for c in ("lang_pred", "lang_score", "lang_trigrams"))
    known = identify(docs, learn_profiles(docs), [docs[c] for c in docs.columns], pred=pred, score=score, trigrams=trigrams)
    floor = F.when(F.char_length("text") >= min_chars, 1.0).when(F.col(trigrams) < least_trigrams, 0.0) \
        .otherwise(F.least(F.lit(1.0), F.col(trigrams) / full_trigrams)) * min_score
    return known.where((F.col(pred) != "und") & (F.col(score) >= floor)).drop(pred, score, trigrams)
