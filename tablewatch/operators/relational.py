"""Relational operators: ``DataFrame -> DataFrame`` functions, composable with ``df.transform``.

Each one only adds nodes to the logical plan; Catalyst collapses projections, pushes
filters and pruned columns to the scan, and AQE picks join strategies from runtime sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import types as TY
from ..functions.names import col, reach, require_identifier, resolve
from ..functions.predicates import text_try_cast

JOIN_TYPES = {
    "inner", "cross", "outer", "full", "fullouter", "full_outer", "left", "leftouter",
    "left_outer", "right", "rightouter", "right_outer", "semi", "leftsemi", "left_semi",
    "anti", "leftanti", "left_anti",
}


def _as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def select_columns(df: DataFrame, columns) -> DataFrame:
    """Keep the given columns (names, ``*``, nested ``a.b``, or Column expressions), in the given order."""
    cols = [reach(df, c) if isinstance(c, str) else c for c in _as_list(columns)]
    return df.select(*cols)


def add_column(df: DataFrame, name: str, expression: Column | str) -> DataFrame:
    """Add or replace one column; ``expression`` is a Column or SQL expression text."""
    return add_columns(df, {name: expression})


def add_columns(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """P2 for several columns in one projection."""
    exprs = {k: (F.expr(v) if isinstance(v, str) else v) for k, v in columns.items()}
    return df.withColumns(exprs)


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    """Keep rows where the condition (Column or SQL text) is TRUE; also HAVING after G1."""
    return df.filter(condition)


def cast_columns(df: DataFrame, schema: Mapping[str, str], on_error: str = "null") -> DataFrame:
    """Cast listed columns to DDL types in one projection, keeping column order.

    ``on_error="null"`` uses ``try_cast`` (bad text becomes NULL, as before ANSI mode);
    ``on_error="raise"`` uses ``cast`` and fails the job on the first bad value.
    """
    if on_error not in ("null", "raise"):
        raise ValueError("on_error must be 'null' or 'raise'")
    wanted = {resolve(df, k): v for k, v in schema.items()}
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if f.name in wanted:
            c = (text_try_cast(c, f.dataType, wanted[f.name]) if on_error == "null"
                 else c.cast(wanted[f.name])).alias(f.name)
        out.append(c)
    return df.select(*out)


def columns_of_type(df: DataFrame, family: str) -> DataFrame:
    """Project the columns of one type family (numeric, timestamp, string, ...)."""
    return df.select(*[col(c) for c in TY.columns_of(df, family)])


#: Sides of an outer join whose rows all stay.
KEPT_SIDES = {"outer": "lr", "full": "lr", "left": "l", "right": "r"}


def join(df1: DataFrame, df2: DataFrame, on, how: str = "inner", skew_safe: bool = True) -> DataFrame:
    """Equi-join on shared column name(s) with USING semantics, or on a Column condition.

    No strategy is forced: with AQE on, a side is broadcast only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold``; otherwise a sort-merge join is used and
    skewed partitions are split (``spark.sql.adaptive.skewJoin``). AQE splits both sides of an
    inner join, only the kept side of a one-sided outer, semi or anti join, and no side of a
    full one. So with ``skew_safe`` and keys given as names, semi and anti joins look up the
    distinct keys of the right side (a hot key is one row there), and outer joins are an inner
    join plus the rows of each kept side whose key is not among the other side's distinct keys.
    That reads a kept side twice; pass ``skew_safe=False`` where the other side is a small
    dimension table, or where a source gives other rows when read again.

    A Column condition needs an equality between the sides; all-pairs joins are refused.
    """
    how_n = how.lower()
    if how_n not in JOIN_TYPES:
        raise ValueError(f"unknown join type {how!r}")
    if on is None or (isinstance(on, (list, tuple)) and not on):
        raise ValueError("join keys are required; all-pairs (cross) joins are not supported")
    if how_n == "cross":
        # With keys Spark treats a cross join as an inner join on them.
        how_n = "inner"
    keys = [on] if isinstance(on, (str, Column)) else list(on)
    if not all(isinstance(k, str) for k in keys):
        out = df1.join(df2, on=on, how=how_n)
        if _all_pairs(out) > _all_pairs(df1) + _all_pairs(df2):
            raise ValueError("the condition has no equality between the two sides; all-pairs joins are not supported")
        return out
    short = how_n.replace("_", "").removesuffix("outer") or "outer"
    if skew_safe and short in ("semi", "leftsemi", "anti", "leftanti"):
        return df1.join(_distinct_keys(df2, keys), on=keys, how=how_n)
    plain = df1.join(df2, on=keys, how=how_n)
    if skew_safe and short in KEPT_SIDES:
        return _outer_by_parts(df1, df2, keys, KEPT_SIDES[short], plain.schema.fields)
    return plain


def _all_pairs(df: DataFrame) -> int:
    """Number of joins in the plan that compare every pair of rows."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct")


def _distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[col(k) for k in keys]).distinct()


def _outer_by_parts(df1: DataFrame, df2: DataFrame, keys: list[str], kept: str, fields: list) -> DataFrame:
    """Outer join as matched rows plus the unmatched rows of each kept side, columns as ``fields``."""
    n_keys = len(keys)
    n_left = len(df1.columns) - n_keys
    parts = [df1.join(df2, on=keys, how="inner")]
    for side, own, other in (("l", df1, df2), ("r", df2, df1)):
        if side in kept:
            alone = own.join(_distinct_keys(other, keys), on=keys, how="left_anti")
            blank = fields[n_keys + n_left:] if side == "l" else fields[n_keys:n_keys + n_left]
            # the join puts the keys first; a number per column keeps clashing names apart
            alone = alone.toDF(*[f"c{i}" for i in range(len(alone.columns))])
            values = [F.col(c) for c in alone.columns]
            nulls = [F.lit(None).cast(f.dataType) for f in blank]
            rest = values[n_keys:] + nulls if side == "l" else nulls + values[n_keys:]
            parts.append(alone.select(*values[:n_keys], *rest))
    out = parts[0].toDF(*[f"c{i}" for i in range(len(fields))])
    for part in parts[1:]:
        out = out.union(part)
    return out.select(*[F.col(f"c{i}").cast(f.dataType) for i, f in enumerate(fields)]).toDF(*[f.name for f in fields])


def group_by_agg(df: DataFrame, group_columns, aggregations: Mapping[str, str | Iterable[str]]) -> DataFrame:
    """G1: group and aggregate ``{column: function or [functions]}``.

    Output columns are named ``{column}_{function}``. ``function`` is any SQL aggregate
    name taking one argument (avg, sum, min, max, count, stddev, ...); it is validated as
    an identifier and called through ``call_function`` (no code is evaluated).
    ``{"*": "count"}`` counts rows; columns and keys may be nested fields (``a.b``).
    An empty key list aggregates the whole frame. NULL keys form one group.
    """
    exprs = []
    for c, fns in aggregations.items():
        value = reach(df, c)
        for fn in ([fns] if isinstance(fns, str) else list(fns)):
            require_identifier(fn)
            if c == "*" and c not in df.columns:
                if fn.lower() != "count":
                    raise ValueError(f"only count takes *, not {fn}")
                value = F.lit(1)
            exprs.append(F.call_function(fn, value).alias(f"{c}_{fn}"))
    if not exprs:
        raise ValueError("no aggregations given")
    keys = [reach(df, k) if isinstance(k, str) else k for k in _as_list(group_columns)]
    return df.groupBy(*keys).agg(*exprs)


def _check_orderable(df: DataFrame, names: list[str], what: str) -> None:
    bad = [n for n in names if not TY.is_orderable(df.schema[n].dataType)]
    if bad:
        raise ValueError(f"{what} cannot use map columns {bad}; pass a subset without them")


def remove_duplicates(df: DataFrame, subset=None, keep_by=None, keep: str = "first") -> DataFrame:
    """One row per key (``subset``; all columns when ``None``).

    Without ``keep_by`` any one row per key survives (``dropDuplicates``).
    With ``keep_by`` the survivor is the row with the smallest (``keep="first"``) or largest
    (``keep="last"``) ``keep_by`` tuple, remaining columns breaking ties, so the result is
    deterministic. Both forms are aggregations with a map-side partial step, so a key
    holding a large share of the rows is reduced before the shuffle (no window that would
    put a hot key into one task). The ``keep_by`` form keeps a struct per key, which Spark
    aggregates sort-based (it spills instead of failing when a task's keys do not fit in
    memory).
    """
    keys = [resolve(df, k) for k in _as_list(subset)] or list(df.columns)
    if keep_by is None:
        _check_orderable(df, keys, "remove_duplicates")
        return df.dropDuplicates(keys) if subset is not None else df.dropDuplicates()
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    order = [resolve(df, k) for k in _as_list(keep_by)]
    _check_orderable(df, keys + order, "remove_duplicates")
    rest = [c for c in df.columns if c not in keys and c not in order]
    pick = F.min if keep == "first" else F.max
    tie = [c for c in rest if TY.is_orderable(df.schema[c].dataType)]
    other = [c for c in rest if c not in tie]
    ordered = F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order + tie)])
    if other:
        by = F.min_by if keep == "first" else F.max_by
        chosen = F.struct(pick(ordered).alias("o"), by(F.struct(*[col(c) for c in other]), ordered).alias("p"))
    else:
        chosen = F.struct(pick(ordered).alias("o"))
    agg = df.groupBy(*[col(k) for k in keys]).agg(chosen.alias("__tw_kept"))
    fields = {c: F.col("__tw_kept.o").getField(f"o{i}") for i, c in enumerate(order + tie)}
    fields.update({c: F.col("__tw_kept.p").getField(c) for c in other})
    out = [col(c) if c in keys else fields[c].alias(c) for c in df.columns]
    return agg.select(*out)
