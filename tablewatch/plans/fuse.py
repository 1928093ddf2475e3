"""Fused aggregations that stay within whole-stage codegen limits on wide tables.

Many metrics over many columns are computed as single-row aggregations and turned
into rows. One aggregate with thousands of expressions would exceed the JVM method
size limit, and Spark would fall back to slow interpreted execution. So the items
are cut into batches of at most ``max_aggs`` aggregate expressions; each batch is one
aggregation whose scan reads only the batch's columns (so total IO stays one pass over
each column) and the batches are unioned into one result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_AGGS = 240


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _agg_col(a):
    return F.expr(a) if isinstance(a, str) else a


def _unpivot(one_row: DataFrame, structs: list) -> DataFrame:
    if all(isinstance(x, str) for x in structs):
        return one_row.selectExpr("inline(array(" + ", ".join(structs) + "))")
    return one_row.select(F.inline(F.array(*[F.expr(x) if isinstance(x, str) else x for x in structs])))


def fused_rows(df: DataFrame, items: Sequence, build: Callable[[int, object], tuple[list, list]],
               max_aggs: int = MAX_AGGS, shared: Sequence = ()) -> DataFrame:
    """Rows from batched one-row aggregations.

    ``build(i, item)`` returns the aggregate expressions of item ``i`` (SQL text
    ``"expr AS alias"`` or Columns; aliases unique per item, e.g. suffixed with ``i``) and
    the row structs made from them (SQL text ``named_struct(...)`` or Columns).
    ``shared`` aggregates (such as ``count(*)``) are added to every batch.
    """
    frames, aggs, structs = [], list(shared), []
    for i, item in enumerate(items):
        a, s = build(i, item)
        if len(aggs) + len(a) > max_aggs and structs:
            frames.append(_unpivot(df.agg(*[_agg_col(x) for x in aggs]), structs))
            aggs, structs = list(shared), []
        aggs += a
        structs += s
    if structs:
        frames.append(_unpivot(df.agg(*[_agg_col(x) for x in aggs]), structs))
    if not frames:
        raise ValueError("nothing to aggregate")
    return union_all(frames)
