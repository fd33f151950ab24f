"""Quality classifier with supervised subword embeddings (operator 6).

Every word and character trigram hashes to a learned vector.  A document is the
mean of its words' and trigrams' vectors, and a softmax layer over the mean
gives the class probabilities; vectors and layer are trained together by numpy
mini-batch gradient descent with a falling rate.

Scoring needs no vectors: the layer is linear, so each bucket's vector is folded
into one number (its part of the difference of the two classes' logits), and a
word's numbers are added once and kept.
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

BUCKETS = 1 << 16
DIMENSIONS = 16
SAMPLE = 4_000                 # labelled documents used for training, at most
EPOCHS, BATCH, RATE = 5, 32, 4.0
AGAIN = hashed(b"\x00same word again", BUCKETS)      # the word bigram of a word with itself


def word_features(word: bytes) -> list[int]:
    """The word and its character trigrams (of bytes, with marks at both ends)."""
    marked = b"<" + word + b">"
    return [hashed(b"\x00" + word, BUCKETS), *(hashed(marked[i:i + 3], BUCKETS) for i in range(len(marked) - 2))]


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features with their shares of all features of the text."""
    words = _words(text)
    ids = [f for w in words for f in word_features(w)] + [AGAIN] * sum(map(bytes.__eq__, words, words[1:]))
    if not ids:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    found, counts = np.unique(np.array(ids, np.int32), return_counts=True)
    return found, counts / counts.sum()


class Model:
    """Logit difference of the classes: the mean of ``parts`` over a text's features, plus ``bias``."""

    def __init__(self, parts: np.ndarray, bias: float):
        self.parts, self.bias = parts, bias


def train(rows: list[tuple], seed: int = 11) -> Model:
    data = Rows(rows)
    classes = np.array([1 - data.y, data.y]).T                       # one-hot
    if not len(rows) or not classes.sum(0).all():                    # nothing to tell apart
        return Model(np.zeros(BUCKETS), 0.0 if not len(rows) else 40.0 if data.y[0] else -40.0)
    weight = len(rows) / (2 * classes.sum(0))                        # both classes count alike
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    steps = EPOCHS * -(-len(rows) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            batch = order[i:i + BATCH]
            ids, shares, owner = data.take(batch)
            mean = np.zeros((len(batch), DIMENSIONS))
            if len(ids):
                full, first = np.unique(owner, return_index=True)        # a text may have no feature
                mean[full] = np.add.reduceat(vectors[ids] * shares[:, None], first)
            z = mean @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - classes[batch]) * (classes[batch] @ weight)[:, None] / len(batch)
            rate = RATE * (1 - step / steps)
            back = g @ layer.T
            layer -= rate * mean.T @ g
            bias -= rate * 0.05 * g.sum(0)
            pull = (-rate * len(batch)) * back[owner] * shares[:, None]
            at = ids[:, None] * DIMENSIONS + np.arange(DIMENSIONS)
            vectors += np.bincount(at.ravel(), pull.ravel(), BUCKETS * DIMENSIONS).reshape(BUCKETS, DIMENSIONS)
            step += 1
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def scorer(model: Model):
    """Scores of texts; a word's numbers are added once and kept with their count."""
    parts = model.parts

    class Words(dict):
        def __missing__(self, word):
            if len(self) >= MAX_WORDS:
                self.clear()
            ids = word_features(word)
            s = self[word] = complex(parts[ids].sum(), len(ids))     # sum and count, added in one go
            return s

    of = Words()

    def score(texts):
        z = []
        for t in texts:
            words = _words(t)
            again = sum(map(bytes.__eq__, words, words[1:]))
            total = sum(map(of.__getitem__, words), 0j) + complex(again * parts[AGAIN], again)
            z.append(total.real / total.imag if total.imag else 0.0)
        return sigmoid(np.array(z) + model.bias)

    return score


def fit(docs: DataFrame, labels: DataFrame, parts: int, held_out: int, bound: int = SAMPLE) -> Model:
    return train(sample_features(docs, labelled_sample(labels, "quality", parts, held_out, bound), features))


def score_quality(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1,
                  bound: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Labels of documents with ``crc32(doc_id as text) mod parts = held_out`` are never used.  Null and empty
    texts get the score of the bias; without labels every score is 0.5, with labels of one class only about
    0 or 1.  Repeated rows give repeated results; of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, parts, held_out, bound))
    return score_documents(docs, parts, held_out, lambda: scorer(held.value))
