"""Vocabularies derived from data (V1, V2) and membership of row tokens in
such a data-derived vocabulary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hausprep.functions.tokens import clean_list_text, has_any, tokens_vocab
from hausprep.operators.common import qcol
from hausprep.session import materialize, materialize_observed

# Size limits for moving a derived vocabulary (checked before any transfer).
LITERAL_MAX_TERMS = 10_000
LITERAL_MAX_BYTES = 1 << 20
BROADCAST_MAX_TERMS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def vocab(df: DataFrame, column: str, *, name: str = "token") -> DataFrame:
    """V1: distinct tokens (T3) of a list-like text column over its non-null
    cells.  A partial aggregate removes repeats before the shuffle."""
    return (df.where(qcol(column).isNotNull())
            .select(F.explode(tokens_vocab(qcol(column))).alias(name))
            .distinct())


def vocab_counts(df: DataFrame, column: str, *, name: str = "token") -> DataFrame:
    """V1 frequency variant: rows per token."""
    return (df.where(qcol(column).isNotNull())
            .select(F.explode(tokens_vocab(qcol(column))).alias(name))
            .groupBy(name).agg(F.count(F.lit(1)).alias("n")))


def garage_vocab(
    df: DataFrame,
    columns: Sequence[str],
    keywords: Sequence[str],
    excluded: str,
    *,
    name: str = "term",
) -> DataFrame:
    """V2: lower-cased tokens of the union of the columns' vocabularies that
    contain any keyword as a substring, without the excluded term (every
    case variant of it)."""
    # All columns in one scan.  A cell without any keyword has no term, nor has a null cell: neither is split.
    none = F.array().cast("array<string>")
    texts = df.select(*[F.lower(clean_list_text(qcol(c))).alias(f"c{i}") for i, c in enumerate(columns)])
    has = lambda text: reduce(lambda a, b: a | b, [F.contains(text, F.lit(k.lower())) for k in keywords])
    tokens = F.concat(*[F.when(has(F.col(t)), tokens_vocab(F.col(t))).otherwise(none) for t in texts.columns])
    return (texts.select(F.explode(tokens).alias(name))
            .where(has(F.col(name)) & (F.col(name) != F.lit(excluded.lower())))
            .distinct())


def measured(terms: DataFrame, column: str = "term") -> tuple[DataFrame, int, int]:
    """A vocabulary written once to the shared checkpoint folder, its number of terms and their UTF-8 bytes, both
    observed in that write."""
    terms = terms.select(F.col(column)).where(F.col(column).isNotNull())
    written, size = materialize_observed(terms, [F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(column))).alias("b")], "vocabulary")
    return written, int(size["n"]), int(size["b"] or 0)


def flag_membership(
    df: DataFrame,
    token_columns: Mapping[str, Column],
    terms: DataFrame,
    *,
    term_column: str = "term",
    strategy: str = "auto",
    salt_buckets: int = 32,
    keys: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add one boolean column per entry of ``token_columns``: does any token
    of that array occur in the vocabulary ``terms``?

    ``keys``: the ``token_key`` of token arrays that hold no ``,`` (T3, T4).
    The vocabulary is data-derived, so it is written once and its size observed in
    that write; nothing is collected before.  The size only chooses how the same answer is reached:

    * ``literal`` - small (<= 10k terms, <= 1 MiB): inlined as a constant
      set, no join at all;
    * ``broadcast`` - up to 2M terms / 64 MiB: tokens are exploded with a
      row key and semi-joined against the broadcast vocabulary;
    * ``shuffle`` - anything larger: the same semi-join as a shuffle join,
      salted: each exploded token gets a salt derived from its row id and
      the vocabulary is replicated once per salt (``salt_buckets`` copies,
      no cross join), so a token carried by a third of all rows is spread
      over ``salt_buckets`` tasks whether or not AQE splits skew.

    The row key of the join strategies is written into a materialised table
    in the shared checkpoint folder, so it is stable if executors are lost
    and stages re-run.
    """
    terms, n_terms, n_bytes = measured(terms, term_column)
    small = n_terms <= LITERAL_MAX_TERMS and n_bytes <= LITERAL_MAX_BYTES
    if strategy == "literal" and not small:
        raise ValueError("vocabulary too large to inline")
    if strategy == "auto":
        strategy = ("literal" if small else
                    "broadcast" if n_terms <= BROADCAST_MAX_TERMS and n_bytes <= BROADCAST_MAX_BYTES else "shuffle")

    if strategy == "literal":
        values = sorted(r[0] for r in terms.collect())
        return df.withColumns({flag: has_any(tok, values, key=(keys or {}).get(flag)) for flag, tok in token_columns.items()})

    rid = "__row_id"
    keyed = materialize(df.withColumn(rid, F.monotonically_increasing_id()), "membership_keyed")
    vocab_side = terms.select(F.col(term_column).alias("__term")).distinct()
    if strategy == "broadcast":
        vocab_side = F.broadcast(vocab_side)
    flags = list(token_columns)
    # All token arrays in one exploded frame tagged with their flag, one
    # semi-join, one aggregate per row id, and a single join back.
    exploded = None
    for flag, tok in token_columns.items():
        part = keyed.select(F.col(rid), F.lit(flag).alias("__flag"),
                            F.explode(F.array_distinct(tok)).alias("__term"))
        exploded = part if exploded is None else exploded.unionByName(part)
    keys = ["__term"]
    if strategy == "shuffle" and salt_buckets > 1:
        exploded = exploded.withColumn("__salt", F.pmod(F.xxhash64(F.col(rid)), F.lit(salt_buckets)))
        vocab_side = vocab_side.select(
            "__term", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>"))
            .alias("__salt"))
        keys = ["__term", "__salt"]
    hits = (exploded.join(vocab_side, keys, "left_semi")
            .groupBy(rid)
            .agg(*[F.max(F.col("__flag") == F.lit(f)).alias(f) for f in flags]))
    out = keyed.join(hits, rid, "left")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags}).drop(rid)
