"""The registered queries of this package: each applies its operator to whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hausprep.llm import (
    decontamination,
    hard_negatives,
    language_id,
    license_scan,
    line_chunks,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    spelling,
    token_counts,
    toxicity,
)
from hausprep.llm.common import id_fold, pick, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hit_spans")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 5, 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    held_out = id_fold(F.col("doc_id"), 4) == 2
    profiles = language_id.learn_profiles(docs.where(~held_out))
    return language_id.identify(docs, profiles, [F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out")])


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 3, 1)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 1024)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1)


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.report(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), 5, 3, drop_every=97)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", relabelled), F.col("id") % 50 == 0, 5, 3)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_decontamination, op2_license_scan, op3_quality_rules, op4_toxicity, op5_language_id, op6_quality_classifier,
             op7_near_dedup, op8_token_counts, op9_packing, op10_line_chunks, op11_spelling, op12_simhash, op13_hard_negatives, pipeline)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op10_line_chunks": line_chunks.ORACLE_SQL, "op11_spelling": spelling.ORACLE_SQL,
            "op13_hard_negatives": hard_negatives.ORACLE_SQL}
