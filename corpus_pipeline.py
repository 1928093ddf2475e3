"""The corpus pipeline: toxicity, quality rules, line de-duplication, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that its predecessor kept and
returns them with the columns of ``documents``; the last returns the packed pieces. Between stages
the documents are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm import line_dedup, packing, quality_rules, simhash, toxicity
from tablewatch.llm.common import free_name, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; learned from the labelled ones among ``docs``.

    Null and empty texts are scored like any other. Repeated rows share their fate. No rows give none.
    """
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null and empty texts have no words, so they go."""
    return quality_rules.passing(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without line runs that stand earlier in the corpus; ``n_chars`` follows the text.
    Null texts stay null; every other column stays as it is."""
    clean = line_dedup.line_dedup(docs, removed_col=None)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies by op2: 4-word shingles, 4 differing
    bits. Ids identify documents here: a repeated id stays if any of its rows is the smallest of its group.
    Texts without words are copies of each other. Every other column stays as it is."""
    groups = simhash.near_duplicates(docs)
    name = free_name("first", docs.columns)
    first = stored(groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias(name)).distinct(), "first")
    return docs.join(first, docs["doc_id"].eqNullSafe(first[name]), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens; null and empty texts have the end token."""
    return packing.pack_documents(docs, "word_bpe_49k.json", 2, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("quality rules", drop_poor), ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_copies), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The trained classifier, the fingerprints and the tokenizer are out of SQL's reach.
ORACLE_SQL: str | None = None
