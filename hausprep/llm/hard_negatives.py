"""Hard negatives by a vertical scan of the dimensions (operator 13).

Vectors lie in columns, one per dimension.  For each anchor the columns are read in
the descending order of the anchor's own magnitudes, and the products are added up.
What the dimensions not yet read can still add lies between the sums of their least
and greatest contributions (from each column's minimum and maximum), so every row has
a lower and an upper bound.  A row leaves the candidate bitmap as soon as its bounds
miss every score window, or enough better rows are certain; the rows left at the end
have exact scores.

An anchor's positives are the best rows of its own label; they give its score windows,
and a second scan finds the best rows of other labels in each window.  Every anchor
meets every row (of its label, then of all labels): anchors and rows are cut into
blocks of fixed size, each pair of blocks is a unit of work on one task, and a unit
gives no more than the few best rows per anchor or window, which Spark ranks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hausprep.llm.common import lookup, record
from hausprep.llm.near_dedup import by_unit
from hausprep.session import materialize

ROW_BLOCK = 4096           # rows of a unit
ANCHOR_BLOCK = 4096        # anchors of a unit
STEP = 8                   # dimensions read between two looks at the bounds
_ORDER = ("id", "code")    # ties: the smaller id, then the smaller hash of label and vector


class Columns:
    """The rows of a unit, a column per dimension; shorter vectors are filled up with zeros."""

    def __init__(self, vectors: np.ndarray, limit: int):
        """``limit``: the greatest magnitude among the anchors, which tells the arithmetic that stays exact."""
        top = int(max(np.abs(vectors).max(initial=0), limit))
        if top >= 1 << 53:
            raise ValueError("a component is beyond 2 ** 53")
        bound = vectors.shape[1] * top * top
        self.dtype = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
        self.columns = np.ascontiguousarray(vectors.T).astype(self.dtype)
        self.least = self.columns.min(1) if len(vectors) else None
        self.greatest = self.columns.max(1) if len(vectors) else None

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, useful: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        """``rows, scores`` of the candidates that ``useful(lower, upper)`` keeps to the end."""
        anchor = anchor.astype(self.dtype)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least, anchor * self.greatest])[:, order]
        # What the dimensions after the first so many can add, at least and at most.
        open_low = np.append(np.cumsum(ends.min(0)[::-1])[::-1], 0)
        open_high = np.append(np.cumsum(ends.max(0)[::-1])[::-1], 0)
        rows, scores = candidates, np.zeros(len(candidates), self.dtype)
        every = len(rows) == self.columns.shape[1]
        for start in range(0, len(order), STEP):
            read = order[start:start + STEP]
            part = self.columns[read] if every else self.columns[read][:, rows]
            scores = scores + anchor[read] @ part
            end = start + len(read)
            kept = useful(scores + open_low[end], scores + open_high[end])
            if not kept.all():
                rows, scores, every = rows[kept], scores[kept], False
            if not len(rows):
                break
        return rows, scores


def best_rows(k: int):
    """Useful for the ``k`` best scores: the upper bound reaches the ``k``-th greatest lower one."""
    def useful(lower, upper):
        if len(lower) <= k:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, len(lower) - k)[len(lower) - k]
    return useful


def window_rows(windows: list[tuple[int, int]], k: int):
    """Useful for the ``k`` best scores of some window: the bounds meet it, and fewer than ``k`` better rows are
    certain to lie in it."""
    def useful(lower, upper):
        kept = np.zeros(len(lower), bool)
        for low, high in windows:
            meets = (upper >= low) & (lower <= high)
            inside = lower[meets & (lower >= low) & (upper <= high)]
            if len(inside) > k:
                meets &= upper >= np.partition(inside, len(inside) - k)[len(inside) - k]
            kept |= meets
        return kept
    return useful


def matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width``, shorter ones filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = vectors.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(n), width), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = vectors.flatten().to_numpy()
    return out


def prepare(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``id, code, label, vec`` (whole numbers ``floor(scale * x)``) of the rows that take part, each different row once."""
    rows = rows.select(rows["vec_id"].cast("long").alias("id"), rows["label"].alias("label"), rows["embedding"].alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite).distinct()
    return rows.select("id", F.xxhash64("label", "v").alias("code"), "label",
                       F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("vec"))


def _tile(rows: DataFrame, anchors: DataFrame, group: list[str]) -> DataFrame:
    """Rows and anchors of each unit in one partition, one after the other, ordered by id: ``unit, windows, id, code, label, vec``.

    Both have ``n_rows`` and ``n_anchors`` of their group; ``windows`` is null in rows."""
    n_rows = F.ceil(F.col("n_rows") / F.lit(ROW_BLOCK)).cast("int")
    n_anchors = F.ceil(F.col("n_anchors") / F.lit(ANCHOR_BLOCK)).cast("int")
    spread = lambda n: F.pmod(F.xxhash64(*_ORDER), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rows = rows.withColumn("windows", F.lit(None).cast("array<long>")).withColumn("r", spread(n_rows)).withColumn("a", every(n_anchors))
    anchors = anchors.withColumn("a", spread(n_anchors)).withColumn("r", every(n_rows))
    columns = [F.concat_ws(" ", "a", "r", *[F.col(g).cast("string") for g in group]).alias("unit"), "windows", "id", "code", "label", "vec"]
    return rows.select(*columns).unionByName(anchors.select(*columns)).repartition("unit").sortWithinPartitions("unit", *_ORDER)


def _unit_scan(units: DataFrame, positives: int | None, negatives: int) -> DataFrame:
    """``id, code, window, other, other_code, score``: in each unit the best rows of each anchor.

    With ``positives``, that many other rows of the unit (the window is null); else the best ``negatives`` rows of
    another label in each window, which is named by its positive score."""
    schema = pa.schema([(c, pa.int64()) for c in ("id", "code", "window", "other", "other_code", "score")])

    def ranked(rows, scores, k):
        """The best ``k``; rows lie in the order of ties."""
        return np.argsort(-scores, kind="stable")[:k] if len(rows) else rows

    def task(batches):
        for unit in by_unit(batches):
            unit = unit.combine_chunks()
            is_anchor = unit.column("windows").is_valid().to_numpy(zero_copy_only=False)
            width = max(unit.column("vec").combine_chunks().value_lengths().to_numpy().max(initial=0), 1)
            vectors = matrix(unit.column("vec"), int(width))
            ids, codes = unit.column("id").to_numpy(), unit.column("code").to_numpy()
            labels = unit.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            rows = np.flatnonzero(~is_anchor)
            if not len(rows):
                continue
            columns = Columns(vectors[rows], int(np.abs(vectors[is_anchor]).max(initial=0)))
            every = np.arange(len(rows))
            windows = unit.column("windows").to_pylist()
            out = []
            for a in np.flatnonzero(is_anchor).tolist():
                if positives:
                    others = every[(ids[rows] != ids[a]) | (codes[rows] != codes[a])]
                    found, scores = columns.scan(vectors[a], others, best_rows(positives))
                    best = ranked(found, scores, positives)
                    out += [(a, None, rows[found[i]], int(scores[i])) for i in best]
                    continue
                bounds = {s: (-(-s // 2), 95 * s // 100) for s in set(windows[a])}
                bounds = {s: b for s, b in bounds.items() if b[0] <= b[1]}
                if not bounds:
                    continue
                found, scores = columns.scan(vectors[a], every[labels[rows] != labels[a]], window_rows(list(bounds.values()), negatives))
                for s, (low, high) in bounds.items():
                    here = np.flatnonzero((scores >= low) & (scores <= high))
                    out += [(a, s, rows[found[i]], int(scores[i])) for i in here[ranked(here, scores[here], negatives)]]
            if out:
                a, window, other, score = zip(*out)
                a, other = np.array(a), np.array(other)
                yield record(schema, ids[a], codes[a], window, ids[other], codes[other], score)

    return units.mapInArrow(task, "id long, code long, window long, other long, other_code long, score long")


def _best(found: DataFrame, group: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "other", "other_code")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``rows(vec_id, embedding, label)``.

    Components become ``floor(scale * x)``; a score is the inner product.  ``is_anchor`` is a condition on ``id``.  The
    positives of an anchor are the best ``positives`` other rows of its label, the negatives of each the best
    ``negatives`` rows of another label whose score is 50 to 95 percent of the positive's.  Ties go to the smaller id.

    Rows with a null id, label, vector or component, or one that is not finite, take no part.  Exactly repeated rows count
    once; different rows of one id are rows of their own, ordered by a hash of label and vector, and as anchors have
    rows of their own.  Of vectors of different lengths the longer one's rest counts nothing.  An anchor without another row
    of its label, or a positive without a row in its window, gives no rows; so does an empty table.  A score beyond
    64 bits raises.  Other columns are not read."""
    rows = materialize(prepare(rows, scale), "vectors")
    anchors = rows.where(is_anchor)
    totals = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(is_anchor).alias("n_anchors")).where("n_anchors > 0")
    totals = materialize(totals, "labels")
    labelled = lookup(rows, totals, "label", "n_rows", how="inner")
    no_window = F.array().cast("array<long>")
    found = _unit_scan(_tile(labelled, labelled.where(is_anchor).withColumn("windows", no_window), ["label"]), positives, negatives)
    found = materialize(_best(found, ["id", "code"], positives), "positives")

    n_rows, n_anchors = rows.count(), anchors.count()
    sized = rows.withColumns({"n_rows": F.lit(n_rows), "n_anchors": F.lit(max(1, n_anchors))})
    windows = found.groupBy("id", "code").agg(F.collect_set("score").alias("windows"))       # of `positives` scores at most
    others = _unit_scan(_tile(sized, sized.where(is_anchor).join(windows, ["id", "code"]), []), None, negatives)
    others = _best(others, ["id", "code", "window"], negatives)
    pairs = found.select("id", "code", F.col("score").alias("window"), F.col("other").alias("positive_id"))
    return pairs.join(others, ["id", "code", "window"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        F.col("window").alias("positive_score"), F.col("score").alias("negative_score"))


#: The same for the registered query, in DuckDB SQL.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 3
"""
