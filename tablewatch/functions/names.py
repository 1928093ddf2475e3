"""Column-name helpers: quoting for SQL text and labels for generated columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quote(name: str) -> str:
    """Backtick-quote a column name for SQL text (inner backticks are doubled)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column reference that is safe for names with spaces, dots or backticks."""
    return F.col(quote(name))


def is_identifier(name: str) -> bool:
    return bool(_IDENTIFIER.match(name))


def require_identifier(name: str, what: str = "function") -> str:
    """Reject anything but a plain identifier (used for aggregate function names)."""
    if not isinstance(name, str) or not is_identifier(name):
        raise ValueError(f"invalid {what} name: {name!r}")
    return name


def label(value) -> str:
    """Label of a category value inside a generated column name.

    Fixed rule of the one-hot columns: ``str(value)`` with spaces replaced by ``_``;
    a missing value is labelled ``None``.
    """
    return str(value).replace(" ", "_")


def unique_names(candidates: list[str], taken: list[str]) -> list[str]:
    """Make generated names unique, case-insensitively, against ``taken`` and each other.

    A clash gets a numeric suffix ``_2``, ``_3`` ... instead of silently replacing a column.
    """
    seen = {t.lower() for t in taken}
    out = []
    for name in candidates:
        final, i = name, 1
        while final.lower() in seen:
            i += 1
            final = f"{name}_{i}"
        seen.add(final.lower())
        out.append(final)
    return out


def resolve(df: DataFrame, name: str) -> str:
    """Return the column's name as spelled in ``df`` (names resolve case-insensitively)."""
    for field in df.schema.fields:
        if field.name == name:
            return field.name
    lowered = [f.name for f in df.schema.fields if f.name.lower() == name.lower()]
    if len(lowered) == 1:
        return lowered[0]
    raise ValueError(f"column {name!r} not found in {df.columns}")


def reach(df: DataFrame, name: str) -> Column:
    """Column for ``name``: a top-level column if there is one, else ``*``, a nested ``a.b`` or ``a.*``."""
    lowered = name.lower()
    if any(c.lower() == lowered for c in df.columns):
        return col(name)
    return F.col(name) if name == "*" or "." in name else col(name)
