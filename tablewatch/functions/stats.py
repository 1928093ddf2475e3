"""Statistic expressions shared by the profile, check and cleaning plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import types as TY


def as_double(c: Column, dt: T.DataType) -> Column:
    """Numeric value as double with NaN turned into NULL (NaN counts as missing)."""
    d = c.cast("double")
    return F.nanvl(d, F.lit(None).cast("double")) if TY.is_floating(dt) else d


def sigma_bounds(stats: dict, k: float) -> tuple[float | None, float | None]:
    """``mean ∓ k·stddev`` from ``column_stats`` values; ``None`` when undefined."""
    m, s = stats.get("mean"), stats.get("stddev")
    if m is None or s is None:
        return None, None
    return m - k * s, m + k * s


def sigma_outlier(x: Column, stats: dict, k: float) -> Column:
    """Strictly outside ``mean ± k·stddev``; no bounds (no data, one row) flag nothing."""
    lo, hi = sigma_bounds(stats, k)
    if lo is None:
        return F.lit(False)
    return (x > lit_double(hi)) | (x < lit_double(lo))


#: Columns of one aggregation, so that its generated code stays within limits.
STATS_BATCH = 48


def column_stats(df: DataFrame, names: list[str]) -> dict[str, dict]:
    """mean, sample stddev, min, max and count of numeric columns in **one** small job (one for each ``STATS_BATCH`` columns).

    Returns ``{column: {"mean", "stddev", "min", "max", "count"}}`` (Python numbers,
    ``None`` where undefined). Only this one row of statistics reaches the driver; the
    values then go back into plans as literals, so later filters can be pushed to the
    scan and no per-row subquery lookup is needed.
    """
    if not names:
        return {}
    from . import sqltext as S
    if len(names) > STATS_BATCH:
        head, tail = names[:STATS_BATCH], names[STATS_BATCH:]
        return column_stats(df, head) | column_stats(df, tail)
    aggs = []
    for i, n in enumerate(names):
        x = S.as_double(n, df.schema[n].dataType)
        aggs += [f"avg({x}) AS m{i}", f"stddev({x}) AS s{i}", f"min({x}) AS lo{i}", f"max({x}) AS hi{i}",
                 f"count({x}) AS n{i}"]
    row = df.agg(*[F.expr(a) for a in aggs]).first()
    return {n: {"mean": row[f"m{i}"], "stddev": row[f"s{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"],
                "count": row[f"n{i}"]} for i, n in enumerate(names)}


def lit_double(v) -> Column:
    return F.lit(None if v is None else float(v)).cast("double")
