"""SQL expression text for the fused per-column reports.

Building one ``Column`` object costs several Python-to-JVM calls; a report with a few
metrics per column over a wide table makes thousands of them, and the Python side
dominates the run time. Internal reports therefore write their aggregate and unpivot
expressions as SQL text, parsed by the JVM in one call. Identifiers are always
backtick-quoted and string literals escaped; doubles go through ``CAST('repr' AS
DOUBLE)``, which round-trips exactly.
"""

from __future__ import annotations

from pyspark.sql import types as T

from . import types as TY
from .names import quote


def ident(name: str) -> str:
    return quote(name)


def string(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def boolean(value: bool) -> str:
    return "true" if value else "false"


def as_double(name: str, dt: T.DataType) -> str:
    """Numeric column as double, NaN as NULL (same rule as ``stats.as_double``)."""
    x = f"CAST({ident(name)} AS DOUBLE)"
    return f"nanvl({x}, CAST(NULL AS DOUBLE))" if TY.is_floating(dt) else x


def extreme_value(name: str, dt: T.DataType) -> str:
    """What a minimum or maximum is taken of: the column's own type; floating as double, NaN as NULL."""
    return as_double(name, dt) if TY.is_floating(dt) else ident(name)


def typed(value, dt: T.DataType) -> str:
    """Literal in the column's own type (timestamp_ntz bounds for timestamp_ntz columns)."""
    return f"CAST({string(str(value))} AS {dt.simpleString()})"


def now(dt: T.DataType) -> str:
    if isinstance(dt, T.TimestampNTZType):
        return "localtimestamp()"
    if isinstance(dt, T.DateType):
        return "current_date()"
    return "current_timestamp()"


def timestamp_implausible(name: str, dt: T.DataType, lo, hi) -> str:
    c = ident(name)
    hi_sql = now(dt) if hi is None else typed(hi, dt)
    return f"({c} IS NULL OR {c} < {typed(lo, dt)} OR {c} > {hi_sql})"


def sigma_outlier(x: str, stats: dict, k: float) -> str:
    m, s = stats.get("mean"), stats.get("stddev")
    if m is None or s is None:
        return "false"
    return f"({x} > {double(m + k * s)} OR {x} < {double(m - k * s)})"


def named_struct(fields: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"{string(k)}, {v}" for k, v in fields) + ")"
