"""Operator 3: exact de-duplication that no group of copies can skew (DataFrame functions only).

Copies are first combined within each task, then by salted digest, then over all salts. Every one
of these steps groups by the text itself beside its SHA-256, so content is compared whole each time;
a text leaves a task once however often it occurs there. What remains is one small row per digest,
joined back to the documents by digest alone, in a join whose large partitions Spark splits. Two
texts under one digest would make the query fail rather than merge them.

Texts are equal when identical after lower-casing A to Z; null counts as empty. The row with the
largest id stays; null ids count as smaller than all. Rows that repeat that id all carry
``kept = true``. Other columns are ignored. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import LOWER, UPPER, lower_ascii, stored

#: Groups that the copies of one text, one from each task, are spread over.
SALTS = 32


def digest_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digest, keep_id, group_size, contents``: one row per digest; ``contents`` counts its texts."""
    rows = _rows(df, id_col, text_col).withColumn("salt", F.spark_partition_id() % SALTS)
    salted = rows.groupBy("salt", "digest", "normal").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    whole = salted.groupBy("digest", "normal").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    return whole.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("n").alias("group_size"),
                                       F.count("*").alias("contents"))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    normal = lower_ascii(F.coalesce(df[text_col], F.lit("")))
    return df.select(df[id_col].alias("doc_id"), normal.alias("normal")).withColumn("digest", F.sha2("normal", 256))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, dropped ones too."""
    groups = stored(digest_groups(df, id_col, text_col), "digests").withColumnRenamed("digest", "shared")
    rows = _rows(df, id_col, text_col).select("doc_id", "digest")
    one = F.when(F.col("contents") > 1, F.raise_error(F.lit("two texts have one SHA-256"))).otherwise(F.col("keep_id"))
    return rows.join(groups, rows["digest"] == groups["shared"]).select(
        "doc_id", one.alias("keep_id"), "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""
