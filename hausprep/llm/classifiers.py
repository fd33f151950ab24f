"""What the two classifiers share: bounded training samples, hashed features, scoring by words."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.llm.common import in_pieces, pick, record

MAX_WORDS = 250_000      # words whose weights a worker keeps


def hashed(feature: bytes, buckets: int) -> int:
    return zlib.crc32(feature) % buckets


def labelled_sample(labels: DataFrame, label: str, parts: int, held_out: int, bound: int) -> DataFrame:
    """``id, y`` of at most ``bound`` labelled documents outside the held-out fold, those with the smallest hash.

    Null ids and labels do not count; of contradicting labels of a document the larger one holds.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("id"), labels[label].cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isNotNull()
               & (F.crc32(F.col("id").cast("string")) % parts != held_out))
    return rows.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(bound)


def sample_features(docs: DataFrame, sample: DataFrame,
                    features: Callable[[str], tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
    """``(y, ids, counts)`` of the sampled documents, ordered by id; features are made by the tasks.

    The sample has a bound, and so has what is broadcast here and what the driver gets.
    """
    schema = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])

    def task(batches):
        for batch in batches:
            for part, texts in in_pieces(batch):
                rows = [features(t) for t in texts]
                yield record(schema, part.column("id"), part.column("y"), [a.astype("<i4").tobytes() for a, _ in rows],
                             [b.astype("<f4").tobytes() for _, b in rows])

    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"])
    found = rows.join(F.broadcast(sample), "id").mapInArrow(task, "id long, y int, ids binary, counts binary").toArrow()
    out = sorted(zip(*(found.column(c).to_pylist() for c in ("id", "y", "ids", "counts"))))
    return [(y, np.frombuffer(a, "<i4"), np.frombuffer(b, "<f4")) for _, y, a, b in out]


class Rows:
    """Documents' features as one sparse matrix in row order."""

    def __init__(self, rows: list[tuple]):
        self.y = np.array([r[0] for r in rows], np.float64)
        self.ids = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int32)
        self.counts = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, np.float32)
        self.starts = np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])]).astype(np.int64)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``ids, counts`` and the row number (in ``rows``) of each entry."""
        n = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(self.starts[rows], n)
        return self.ids[at], self.counts[at], owner


def score_documents(docs: DataFrame, parts: int, held_out: int, make_scorer: Callable) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; ``make_scorer()`` gives, once per task,
    a function from texts to scores.  ``held_out`` is null without an id."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def task(batches):
        scorer = make_scorer()
        for batch in batches:
            for part, texts in in_pieces(batch):
                yield record(schema, part.column("doc_id"), scorer(texts))

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(task, "doc_id long, score double").select(
        "doc_id", ((F.crc32(F.col("doc_id").cast("string")) % parts) == held_out).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))
