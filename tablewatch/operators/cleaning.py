"""Cleaning operators: missing values and outliers.

Statistics the cleaning needs (means, standard deviations) come from one small
aggregate job over all listed columns; only that one row of numbers reaches the driver
and goes back into the plan as literals (so range filters push down to the scan). No
cross join and no ``avg() over ()`` window, which would move every row into one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY
from ..functions.names import col, resolve
from ..functions.predicates import is_missing
from ..functions.stats import column_stats, lit_double, sigma_bounds


def _as_list(x) -> list | None:
    if x is None:
        return None
    return [x] if isinstance(x, str) else list(x)


def drop_missing(df: DataFrame, subset=None, how: str = "any", thresh: int | None = None) -> DataFrame:
    """Drop rows with NULL (or NaN) in ``subset`` (all columns when ``None``)."""
    subset = _as_list(subset)
    if subset is not None:
        subset = [resolve(df, c) for c in subset]
    return df.dropna(how=how, thresh=thresh, subset=subset)


def _fill_compatible(value, dt: T.DataType) -> bool:
    if isinstance(value, bool):
        return isinstance(dt, T.BooleanType)
    if isinstance(value, (int, float)):
        return TY.is_numeric(dt)
    if isinstance(value, str):
        return TY.is_string(dt)
    return False


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL (and NaN in float/double) with per-column constants.

    The value is converted to the column's type (18.33 becomes 18 in an int column).
    Incompatible pairs (text into a number column, ...) raise ``ValueError`` before any
    job runs instead of failing inside the cast.
    """
    fixed = {}
    for name, value in values.items():
        real = resolve(df, name)
        dt = df.schema[real].dataType
        if not _fill_compatible(value, dt):
            raise ValueError(f"cannot fill column {real!r} ({dt.simpleString()}) with {value!r}")
        fixed[real] = value
    if not fixed:
        return df
    return df.na.fill(fixed)


def _default_for(dt: T.DataType):
    if isinstance(dt, T.BooleanType):
        return False
    if TY.is_numeric(dt):
        return 0
    if TY.is_string(dt):
        return ""
    return None


def fill_defaults(df: DataFrame, subset=None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Fill missing values with type defaults (numbers 0, text "", booleans false).

    ``defaults`` overrides per column. Columns of other types stay as they are.
    """
    names = [resolve(df, c) for c in (_as_list(subset) or df.columns)]
    values = {}
    for name in names:
        v = (defaults or {}).get(name, _default_for(df.schema[name].dataType))
        if v is not None:
            values[name] = v
    return fill_constant(df, values)


def handle_missing(df: DataFrame, strategy: str = "drop", subset=None) -> DataFrame:
    """C1/C3/C4 dispatcher: ``"drop"`` or ``"fill"``; anything else raises ``ValueError``."""
    if strategy == "drop":
        return drop_missing(df, subset)
    if strategy == "fill":
        return fill_defaults(df, subset)
    raise ValueError(f"invalid strategy for handling missing values: {strategy!r}")


def _numeric(df: DataFrame, columns) -> list[str]:
    names = [resolve(df, c) for c in (_as_list(columns) or TY.columns_of(df, "numeric"))]
    for n in names:
        TY.require(df, n, TY.is_numeric, "numeric")
    return names


def impute_mean(df: DataFrame, columns=None) -> DataFrame:
    """Replace missing values (NULL, NaN) of numeric columns with the column mean.

    The means of all columns come from one small aggregate job and are filled in as
    literals, cast back to the column type (truncated for integers, rounded for
    decimals). A column with no value at all stays as it is.
    """
    names = _numeric(df, columns)
    if not names:
        return df
    stats = column_stats(df, names)
    repl = {}
    for n in names:
        dt = df.schema[n].dataType
        mean = stats[n]["mean"]
        if mean is None:
            continue
        present = F.nanvl(col(n), F.lit(None).cast(dt)) if TY.is_floating(dt) else col(n)
        repl[n] = F.coalesce(present, lit_double(mean).cast(dt))
    return df.withColumns(repl) if repl else df


def _keep(raw: Column, dt: T.DataType, st: dict, k: float, drop_null: bool) -> Column:
    """Row filter for one column: inside the bounds, or missing when missing rows are kept.

    The range test is a plain ``c >= lo AND c <= hi`` on the raw column, which the
    scan can use (parquet filter pushdown and row-group skipping). NULL is not inside
    and NaN (larger than every number) fails ``c <= hi``, so with ``drop_null`` the range
    test alone is the filter.
    """
    lo, hi = sigma_bounds(st, k)
    missing = is_missing(raw, dt)
    if lo is None:
        return ~missing if drop_null else F.lit(True)
    in_range = (raw >= F.lit(lo)) & (raw <= F.lit(hi))
    if drop_null:
        return in_range
    return missing | in_range


def remove_outliers(df: DataFrame, columns=None, k: float = 3.0, sequential: bool = False,
                    drop_null: bool = False) -> DataFrame:
    """Keep rows with every listed column inside ``mean ± k·stddev`` (bounds included).

    Default: the bounds of all columns come from one small aggregate job over the input
    and missing values are kept. ``sequential=True`` recomputes each column's bounds
    after the previous column's filter (one small job per column), and
    ``drop_null=True`` drops rows with a missing value, which together give the
    column-by-column behaviour of a loop of filters. Columns without bounds (no values,
    one value) remove nothing. The bounds are literals, so the range filter can be
    pushed down to the scan.
    """
    names = _numeric(df, columns)
    if not names:
        return df
    if not sequential:
        stats = column_stats(df, names)
        cond = None
        for n in names:
            dt = df.schema[n].dataType
            c = _keep(col(n), dt, stats[n], k, drop_null)
            cond = c if cond is None else cond & c
        return df.filter(cond)
    out = df
    for n in names:
        dt = out.schema[n].dataType
        st = column_stats(out, [n])[n]
        out = out.filter(_keep(col(n), dt, st, k, drop_null))
    return out


__all__ = [
    "drop_missing", "fill_constant", "fill_defaults", "handle_missing", "impute_mean",
    "remove_outliers",
]
