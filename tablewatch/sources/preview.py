"""Row previews (S3). Failing-row samples (S4) live in ``plans.checks.failing_rows``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def head(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """S3: the first ``n`` rows; with ``order_by`` repeatable (a top-n, not a full sort)."""
    if order_by is not None:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(n)
