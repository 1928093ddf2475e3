"""Checks on streams.

The checks are the same specs as for batch data; there are no stream-only operators.
Row-level operators (projections, filters, casts, fills, ``timestamp_parts``) work on a
streaming DataFrame as they are. Two ways to run checks on a stream:

* ``check_each_batch``: run ``run_checks`` on every micro-batch (any check, including
  duplicates and kσ outliers over the batch) and write the result rows to a table,
  partitioned by batch id and overwritten per batch, so a retried batch replaces its
  own rows instead of adding a second copy.
* ``running_check_counts``: cumulative failing counts over the whole stream as a
  stateful streaming aggregation; the state lives in the query checkpoint, so the
  counts survive restarts and lost executors. Predicate checks only (distinct counts
  are not supported on streams).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.checks import Check, run_checks
from ..session import checkpoint_dir


def check_each_batch(stream: DataFrame, make_checks: Callable[[DataFrame], list[Check]], results_path: str,
                     checkpoint_location: str | None = None, query_name: str | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Start a query that writes ``run_checks`` results of every micro-batch to ``results_path``.

    Without ``checkpoint_location`` the checkpoint lies in the shared folder under the query's name
    or, for a query without one, a name that follows from ``results_path``: streams that write to
    different places never share a checkpoint, and a restarted one finds its own.
    """
    spark = stream.sparkSession
    own_name = query_name or "check_each_batch-" + hashlib.sha256(results_path.encode()).hexdigest()[:16]
    ckpt = checkpoint_location or os.path.join(checkpoint_dir(spark), own_name)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        res = run_checks(batch, make_checks(batch)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (res.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(results_path))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def running_check_counts(stream: DataFrame, checks: list[Check]) -> DataFrame:
    """Streaming DataFrame of cumulative ``(check, column, metric, failing, total)``.

    Write it with ``outputMode("complete")`` or ``("update")``.
    """
    if any(c.bad is None for c in checks):
        raise ValueError("only predicate checks can run as a streaming aggregation")
    aggs = [F.count(F.lit(1)).alias("__total")] + [F.count_if(c.bad).alias(f"__f{i}") for i, c in enumerate(checks)]
    rows = [F.struct(F.lit(c.check).alias("check"), F.lit(c.column).cast("string").alias("column"),
                     F.lit(c.metric).alias("metric"), F.col(f"__f{i}").cast("long").alias("failing"),
                     F.col("__total").alias("total"))
            for i, c in enumerate(checks)]
    return stream.agg(*aggs).select(F.inline(F.array(*rows)))
