"""Distances and cosines worked out a second time, by their definitions."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from hausprep.llm import language_id, quality_rules


def entropy(p):
    return -sum(x * math.log2(x) for x in p if x > 0)


def test_jensen_shannon_distance_by_entropies():
    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.randint(1, 9)
        p, q = ([rnd.choice([0, 0, 1, 5, rnd.random()]) for _ in range(n)] for _ in range(2))
        if not sum(p) or not sum(q):
            continue
        a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
        want = math.sqrt(max(0.0, entropy([(x + y) / 2 for x, y in zip(a, b)]) - (entropy(a) + entropy(b)) / 2))
        got = quality_rules.distance(np.array(p, float), np.array(q, float))
        assert abs(got - want) < 1e-7 and 0 <= got <= 1 + 1e-12
    assert quality_rules.distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1.0


def trigram_vector(text, dimensions, seed):
    """Sum of bound letter vectors, one trigram after the other; a gap is any run of non-letters."""
    rng = np.random.default_rng(seed)
    letters = rng.integers(0, 2, (2048, dimensions), np.int8).astype(np.int64) * 2 - 1

    def slot(c):
        if not c.isalpha():
            return 0
        return ord(c) if ord(c) < 1024 else 1024 + ((ord(c) * 2654435761 % (1 << 64)) >> 15) % 1024
    slots = [0]
    for c in text.lower():
        if slot(c) or slots[-1]:
            slots.append(slot(c))
    if slots[-1]:
        slots.append(0)
    out = np.zeros(dimensions, np.int64)
    for a, b, c in zip(slots, slots[1:], slots[2:]):
        out += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
    return out


def test_language_cosines_by_definition(spark):
    learned = [("en", "The quick brown fox, it jumps over the lazy dog! 12 times."), ("fr", "Où est la bibliothèque? Elle est là-bas."),
               ("en", "Again and again the fox"), ("de", "Über allen Gipfeln ist Ruh"), (None, "nothing to learn")]
    texts = ["the dog", "la bibliothèque est là", "Gipfel und Ruh", "漢字 кто там", "...", "", None, "a", "x" * 300 + " the fox"]
    docs = spark.createDataFrame(learned, "lang string, text string")
    dimensions, seed = 256, 5
    profiles = language_id.learn_profiles(docs, dimensions, seed)
    want = {}
    for lang in ("de", "en", "fr"):
        v = sum(trigram_vector(t, dimensions, seed) for l, t in learned if l == lang).astype(float)
        want[lang] = v / np.linalg.norm(v)
        assert np.allclose(profiles[lang], want[lang])
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = language_id.identify(rows, profiles, [F.col("i")], dimensions, seed).orderBy("i").collect()
    for t, row in zip(texts, out):
        v = trigram_vector(t or "", dimensions, seed).astype(float)
        if not any(c.isalpha() for c in t or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        cosines = {lang: float(p @ v / np.linalg.norm(v)) for lang, p in want.items()}
        assert abs(row["score"] - max(0.0, max(cosines.values()))) < 1e-5 and cosines[row["lang_pred"]] == max(cosines.values())
