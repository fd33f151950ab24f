"""Exact quantiles with linear interpolation, without moving a column's values.

Spark's ``percentile`` is exact but keeps every distinct value of a group in one
aggregation buffer; for a global quantile that buffer is the whole column.
``percentile_approx`` is bounded but approximate.  Here the approximate one only
says where to look:

1. one aggregate counts the values and takes a sketch of them, from which two values
   are read between which each wanted rank should lie (the bracket);
2. one aggregate counts exactly how many values lie below the bracket and inside it, so
   it is known whether the ranks lie inside; a bracket that misses is widened, one that
   still holds more than ``MOST`` values is sketched again, its own values only;
3. only the values inside the bracket are grouped and sorted, ``MOST`` or a single one per
   bracket, and the values at the wanted ranks are picked.

Nothing but these numbers is shuffled or reaches the driver, however many distinct
values there are; a value that fills a third of the column is a counter.  Missing values
and NaN are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hausprep.operators.common import qcol

#: Values of a bracket that are sorted.
MOST = 1 << 16
#: Of a sketch: ranks are off by one in so many at most, and its size is in proportion.
ACCURACY = 500


@dataclass
class _Bracket:
    """Where the values of ranks ``first`` and ``last`` of column ``i`` lie."""

    i: int
    first: int
    last: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    margin: float = 2 / ACCURACY
    done: bool = False

    def holds(self, v: Column) -> Column:
        return (v >= F.lit(self.low)) & (v <= F.lit(self.high))


def _narrow(rows: DataFrame, values: list[Column], brackets: list[_Bracket]) -> None:
    """Shrink the brackets that hold too many values, by a sketch of what they hold."""
    sketches = []
    for k, b in enumerate(brackets):
        low = (b.first - b.below) / b.inside - b.margin
        high = (b.last - b.below + 1) / b.inside + b.margin
        held = F.when(b.holds(values[b.i]), values[b.i])
        sketches.append(F.percentile_approx(held, [max(low, 0.0), min(high, 1.0)], ACCURACY).alias(f"s{k}"))
    tried, counts = [], []
    for k, (b, (low, high)) in enumerate(zip(brackets, rows.agg(*sketches).first())):
        # At an end of what the bracket holds, the sketch may be off; the bracket itself is not.
        low = b.low if (b.first - b.below) / b.inside <= b.margin else low
        high = b.high if (b.last - b.below + 1) / b.inside >= 1 - b.margin else high
        tried.append(_Bracket(b.i, b.first, b.last, low, high))
        counts += [F.count_if(values[b.i] < F.lit(low)), F.count_if(tried[k].holds(values[b.i]))]
    exact = list(rows.agg(*[c.alias(f"n{k}") for k, c in enumerate(counts)]).first())
    for b, t, below, inside in zip(brackets, tried, exact[::2], exact[1::2]):
        if not below <= b.first <= b.last < below + inside:
            b.done, b.margin = b.margin >= 1, b.margin * 8        # a miss: wider, in the end all of it
            continue
        # Ranks do not tell values apart that fill most of a bracket; grouped, they are few.
        b.done = t.low == t.high or inside > 0.9 * b.inside
        b.low, b.high, b.below, b.inside = t.low, t.high, below, inside


def _at_ranks(rows: DataFrame, values: list[Column], brackets: list[_Bracket]) -> dict[tuple[int, int], float]:
    """The values at the first and last rank of each bracket, by its number and the rank."""
    held = F.filter(F.array(*[
        F.struct(F.lit(k).alias("k"), values[b.i].alias("v"), b.holds(values[b.i]).alias("held")) for k, b in enumerate(brackets)
    ]), lambda s: F.coalesce(s["held"], F.lit(False)))
    counted = rows.select(F.explode(held).alias("s")).groupBy("s.k", "s.v").agg(F.count(F.lit(1)).alias("n"))
    known = F.array(*[F.struct(*[F.lit(x).cast("long") for x in (b.below, b.first, b.last)]) for b in brackets])[F.col("k")]
    upto = known["col1"] + F.sum("n").over(Window.partitionBy("k").orderBy("v"))
    ranked = counted.select("k", "v", (upto - F.col("n")).alias("begin"), upto.alias("end"), known["col2"].alias("first"), known["col3"].alias("last"))
    covers = lambda rank: (F.col("begin") <= rank) & (rank < F.col("end"))
    out = {}
    for r in ranked.where(covers(F.col("first")) | covers(F.col("last"))).collect():      # two rows per bracket at most
        for rank in (r["first"], r["last"]):
            if r["begin"] <= rank < r["end"]:
                out[r["k"], rank] = r["v"]
    return out


def quantile_values(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> list[list[float | None]]:
    """The quantiles of each column as numbers; null without any value."""
    probs = [float(p) for p in probabilities]
    if any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    rows = df.select(*[qcol(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    # -0.0 equals 0.0; NaN is missing.
    values = [F.when(F.col(f"v{i}") == 0, F.lit(0.0)).when(~F.isnan(f"v{i}"), F.col(f"v{i}")) for i in range(len(columns))]
    totals = list(rows.agg(*[F.count(v) for v in values]).first()) if columns else []
    brackets, of = [], {}
    for i, n in enumerate(totals):
        for j, p in enumerate(probs):
            if n:
                h = (n - 1) * p
                of[i, j] = len(brackets)
                brackets.append(_Bracket(i, math.floor(h), math.ceil(h), inside=n))
    while any(b.inside > MOST and not b.done for b in brackets):
        _narrow(rows, values, [b for b in brackets if b.inside > MOST and not b.done])
    found = _at_ranks(rows, values, brackets) if brackets else {}
    out: list[list[float | None]] = [[None] * len(probs) for _ in columns]
    for (i, j), k in of.items():
        b = brackets[k]
        h = (totals[i] - 1) * probs[j]
        low, high = found[k, b.first], found[k, b.last]
        out[i][j] = low if low == high else low + (h - b.first) * (high - low)
    return out


def quantile_frame(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *,
                   names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles of several numeric columns as one frame
    ``(column_name, <names...>)`` with one row per column (null without any value).

    The numbers are worked out at once, by a few aggregates over all columns together."""
    names = list(names) if names else [f"q{int(round(float(p) * 100))}" for p in probabilities]
    found = quantile_values(df, columns, probabilities)
    schema = ", ".join(["column_name string", *[f"`{n}` double" for n in names]])
    return df.sparkSession.createDataFrame([(c, *q) for c, q in zip(columns, found)], schema)


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], *,
                    names: Sequence[str] | None = None) -> DataFrame:
    """One row with the exact quantiles of one column."""
    return quantile_frame(df, [column], probabilities, names=names).drop("column_name")
