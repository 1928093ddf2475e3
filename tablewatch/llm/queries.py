"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tablewatch.llm import (
    alignment,
    bpe,
    exact_dedup,
    hard_negatives,
    line_dedup,
    mixing,
    packing,
    quality_bayes,
    quality_rules,
    simhash,
    token_files,
    toxicity,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(_table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken", public_tokenizers.PATTERN,
                      with_ids=False)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), "word_bpe_49k.json", 2, with_ids=False)


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bayes.site_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", F.col("source_sizes")[0].alias("source_size"),
                        F.col("source_targets")[0].alias("target"), "taken")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    shifted = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.hard_negatives(hard_negatives.vectors(rows, label=shifted), F.col("vec_id") % 100 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run} | {
    f.__name__: f for f in (
        op1_byte_bpe, op2_simhash, op3_exact_dedup, op4_packing, op5_site_quality, op6_line_dedup, op7_token_files,
        op8_toxicity, op9_quality_rules, op10_warc, op11_mixing,
        op12_hard_negatives, op13_alignment)}

#: Operators that SQL cannot express have none.
SQL: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op9_quality_rules": quality_rules.SQL,
    "op11_mixing": mixing.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op10_warc": """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN other THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN other THEN first END AS refers_to
FROM (SELECT page_id, html, first, coalesce(strlen(coalesce(html, '')) >= 100 AND page_id <> first, false) AS other
      FROM (SELECT page_id, html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))
""",
}

if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
