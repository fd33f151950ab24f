"""A corpus through five stages: language, repeated lines, near duplicates, benchmark passages, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
is written as Parquet and read again as the next stage's ``docs``.  All stages but the last return the columns of
``documents``.  ``run`` applies them to the documents of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hausprep.llm import decontamination, language_id, line_chunks, near_dedup, packing
from hausprep.llm.common import fresh_name, table
from hausprep.llm.queries import tokenizer_path
from hausprep.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language (operator 5)."""
    return language_id.reject_unknown(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks and passages of lines that occurred before (operator 10); documents of nothing else go."""
    removed = fresh_name(docs, "removed")
    out = line_chunks.dedup_lines(docs, removed=removed, passages=True)
    return out.where((F.col(removed) == 0) | F.col("text").rlike(r"\S")).drop(removed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (operator 7)."""
    return near_dedup.dedup(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; documents with much of it go (operator 1)."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in full windows (operator 9)."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 1)


STAGES = [
    ("language", known_language),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

#: SQL can express neither the language profiles, the sampling nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
