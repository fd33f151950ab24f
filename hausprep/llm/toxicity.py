"""Toxicity by non-negative positive-unlabelled learning (operator 4).

A linear classifier over hashed words and word beginnings is trained from
confirmed toxic documents (positives) and documents whose labels are not looked
at (unlabelled).  With the class prior ``pi``, the risk of a score function is

    pi * mean_P[loss(+)] + max(0, mean_U[loss(-)] - pi * mean_P[loss(-)])

The second term estimates the risk on the clean documents; where a mini-batch
makes it negative, which only an overfitted model can, the step goes the other
way, as in the non-negative estimator of Kiryo et al. (2017).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from hausprep.llm.classifiers import (
    MAX_WORDS,
    Rows,
    hashed,
    labelled_sample,
    sample_features,
    score_documents,
    sigmoid,
)
from hausprep.llm.common import words_of

BUCKETS = 1 << 18
BEGINNINGS = (3, 4, 5, 6)      # bytes of a word's beginning that are features of it
SAMPLE = 12_000                # labelled documents used for training, at most
LEAST_POSITIVE, LEAST_Z = 5, 5.0     # a feature's toxic documents, and how far it is from chance there
EPOCHS, BATCH, RATE, DECAY = 30, 400, 0.05, 3e-4
SLACK, BACK = 0.02, 1.0        # the non-negative estimator's beta and gamma


def word_features(word: bytes) -> list[int]:
    return [hashed(b"=" + word, BUCKETS), *(hashed(word[:n], BUCKETS) for n in BEGINNINGS if len(word) >= n)]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of the text, each counting 1."""
    found = np.unique(np.array([f for w in set(words_of(text)) for f in word_features(w)], np.int32))
    return found, np.ones(len(found))


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias


def screened(rows: list[tuple]) -> np.ndarray:
    """Features that are much likelier in the positives than in the unlabelled documents; the others
    could only fit the noise of the sample."""
    n_positive = sum(y for y, _, _ in rows)
    positive, all_rows = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for y, ids, _ in rows:
        all_rows[ids] += 1
        if y:
            positive[ids] += 1
    p, u = positive / n_positive, all_rows / len(rows)
    z = (p - u) / np.sqrt(np.maximum(u * (1 - u), 1e-9) / n_positive)
    return np.flatnonzero((positive >= min(LEAST_POSITIVE, n_positive)) & (z >= LEAST_Z))


def train(rows: list[tuple], prior: float, seed: int = 7) -> Model:
    """Fit to ``(y, ids, counts)``; only the rows with ``y = 1`` use their label."""
    weights = np.zeros(BUCKETS, np.float32)
    if not any(y for y, _, _ in rows):
        return Model(weights, -40.0)
    kept = screened(rows)
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    data = Rows([(y, place[ids[place[ids] >= 0]], counts[place[ids] >= 0]) for y, ids, counts in rows])
    positive, unlabelled = np.flatnonzero(data.y == 1), np.arange(len(rows))
    rng = np.random.default_rng(seed)
    n = len(kept) + 1
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)           # the last weight is the bias
    w[-1] = -2.0
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(unlabelled)
        for i in range(0, len(order), BATCH):
            own = (rng.choice(positive, min(len(positive), BATCH // 2), replace=False), order[i:i + BATCH])
            grads, risks = [], []
            for batch, signs in zip(own, ((1, -1), (-1,))):
                ids, counts, owner = data.take(batch)
                z = np.bincount(owner, w[ids] * counts, len(batch)) + w[-1]
                for sign in signs:
                    risks.append(float(np.mean(np.logaddexp(0.0, -sign * z))))
                    g = -sign * sigmoid(-sign * z) / len(batch)
                    full = np.bincount(ids, g[owner] * counts, n)
                    full[-1] = g.sum()
                    grads.append(full)
            negative = risks[2] - prior * risks[1]
            if negative >= -SLACK:
                g = prior * grads[0] + grads[2] - prior * grads[1]
            else:
                g = BACK * (prior * grads[1] - grads[2])
            step += 1
            g += DECAY * w
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights[kept] = w[:-1]
    return Model(weights, float(w[-1]))


def scorer(model: Model):
    """Scores of texts; the features of a word that carry weight are kept once computed."""
    weights = model.weights.tolist()

    class Words(dict):
        def __missing__(self, word):
            if len(self) >= MAX_WORDS:
                self.clear()
            ids = self[word] = tuple(f for f in word_features(word) if weights[f])
            return ids

    of = Words()

    def logit(text):
        found = set()
        for ids in map(of.__getitem__, set(words_of(text))):
            if ids:
                found.update(ids)
        return sum(weights[f] for f in sorted(found))

    return lambda texts: sigmoid(np.array([logit(t) for t in texts]) + model.bias)


def fit(docs: DataFrame, labels: DataFrame, parts: int, held_out: int, bound: int = SAMPLE) -> Model:
    """Train on at most ``bound`` labelled documents outside the held-out fold.

    The class prior is the share of toxic documents among the sampled ones."""
    rows = sample_features(docs, labelled_sample(labels, "toxic", parts, held_out, bound), features)
    return train(rows, float(np.mean([r[0] for r in rows])) if rows else 0.0)


def score_toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0,
                   bound: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Labels of documents with ``crc32(doc_id as text) mod parts = held_out`` are never used.  Null and empty
    texts have no word and get the score of the bias; with no toxic example every score is about 0.  Repeated
    rows give repeated results; of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, parts, held_out, bound))
    return score_documents(docs, parts, held_out, lambda: scorer(held.value))
