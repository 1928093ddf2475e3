"""Check results as a DataFrame, and the consumers of it (N1, N2, raise-on-failure).

A check outcome is a row, not a print, an exception or an HTTP call: callers can store
it (``append_results``), turn failures into alert rows (``alerts``) or raise
(``raise_on_failure``). Delivery of alerts to a chat service is left to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("column", T.StringType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("failing", T.LongType(), True),
    T.StructField("total", T.LongType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("message", T.StringType(), True),
])

# Fixed value: the title used for alerts of a failed ETL check.
ALERT_TITLE = "ETL Process Error"


class CheckFailed(ValueError):
    """Raised by ``raise_on_failure`` with every failed check in one message."""


def raise_on_failure(results: DataFrame) -> None:
    """Raise ``CheckFailed`` listing every failed check (one small job on the result rows)."""
    failed = results.filter(F.col("status") == "fail").orderBy("check", "column", "metric").collect()
    if failed:
        raise CheckFailed("; ".join(r["message"] for r in failed))


def alerts(results: DataFrame, title: str = ALERT_TITLE) -> DataFrame:
    """One ``(title, text)`` row per failed check, ready for any notifier."""
    return results.filter(F.col("status") == "fail").select(
        F.lit(title).alias("title"), F.col("message").alias("text"))


def log_rows(results: DataFrame) -> DataFrame:
    """Results as log records ``(level, message)``; failures are ERROR, the rest INFO."""
    return results.select(
        F.when(F.col("status") == "fail", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
        F.col("message"))


def append_results(results: DataFrame, path: str, run_id: str | None = None, fmt: str = "parquet") -> None:
    """N1 sink: add result rows (with their time) to a table of files in ``path``.

    With ``run_id`` the table is partitioned by it, and a run that is repeated replaces its own rows
    and no others. Without one, rows are appended each time. A table holds either kind, not both.
    """
    out = results.withColumn("run_at", F.current_timestamp())
    if run_id is None:
        out.write.mode("append").format(fmt).save(path)
    else:
        out = out.withColumn("run_id", F.lit(run_id))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").format(fmt).save(path)
