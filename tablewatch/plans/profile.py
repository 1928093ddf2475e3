"""Profiling: counts, moments, quantiles, value counts and the whole-table quality report.

Each report is one aggregation over the input (plus one small statistics job where a
second pass needs first-pass statistics) and comes back as a tidy DataFrame: one row per
column, or per (column, metric). NaN is treated as missing for every statistic.
Medians are exact by radix selection (``quantiles.exact_quantiles_many``) or come from sketches that
merge in two levels (``quantiles.approx_quantiles``): memory per task is bounded by ``accuracy`` and
the rank error is at most ``n / accuracy`` (with 99 % confidence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sqltext as S
from ..functions import types as TY
from ..functions.names import col, resolve
from .checks import key_counts
from .fuse import MAX_AGGS, fused_rows, union_all
from .quantiles import approx_quantiles, as_text, exact_quantiles_many

DEFAULT_ACCURACY = 10000


def _names(df: DataFrame, columns, family: str | None = None) -> list[str]:
    if columns is None:
        return TY.columns_of(df, family) if family else list(df.columns)
    names = [resolve(df, c) for c in ([columns] if isinstance(columns, str) else columns)]
    if family == "numeric":
        for n in names:
            TY.require(df, n, TY.is_numeric, "numeric")
    return names


def row_count(df: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))


def null_counts(df: DataFrame, columns=None, nan_as_null: bool = False) -> DataFrame:
    """NULL count per column in one aggregation (NaN too with ``nan_as_null``)."""
    names = _names(df, columns)

    def build(i, n):
        q = S.ident(n)
        pred = f"{q} IS NULL"
        if nan_as_null and TY.is_floating(df.schema[n].dataType):
            pred += f" OR isnan({q})"
        return ([f"count_if({pred}) AS c{i}"],
                [S.named_struct([("column", S.string(n)), ("null_count", f"CAST(c{i} AS BIGINT)")])])
    return fused_rows(df, names, build)


def describe(df: DataFrame, columns=None) -> DataFrame:
    """Count / mean / stddev / min / max of numeric columns.

    ``min``/``max`` are text, taken in the column's own type: a bigint or decimal keeps
    every digit. Mean and stddev are doubles.
    """
    names = _names(df, columns, "numeric")
    if not names:
        raise ValueError("no numeric columns")

    def build(i, n):
        dt = df.schema[n].dataType
        x, v = S.as_double(n, dt), S.extreme_value(n, dt)
        return ([f"count({x}) AS n{i}", f"avg({x}) AS m{i}", f"stddev({x}) AS s{i}",
                 f"CAST(min({v}) AS STRING) AS lo{i}", f"CAST(max({v}) AS STRING) AS hi{i}"],
                [S.named_struct([("column", S.string(n)), ("count", f"n{i}"), ("mean", f"m{i}"),
                                 ("stddev", f"s{i}"), ("min", f"lo{i}"), ("max", f"hi{i}")])])
    return fused_rows(df, names, build)


def skew_kurt(df: DataFrame, columns=None) -> DataFrame:
    """Population skewness and excess kurtosis per numeric column (one job)."""
    names = _names(df, columns, "numeric")

    def build(i, n):
        x = S.as_double(n, df.schema[n].dataType)
        return ([f"skewness({x}) AS sk{i}", f"kurtosis({x}) AS ku{i}"],
                [S.named_struct([("column", S.string(n)), ("skewness", f"sk{i}"), ("kurtosis", f"ku{i}")])])
    return fused_rows(df, names, build)


def skewness(df: DataFrame, column: str) -> DataFrame:
    """G13 for one column (``ValueError`` when it is not numeric)."""
    return skew_kurt(df, [column]).select("column", "skewness")


def _median_sql(medians: dict, name: str, median_as_text: bool) -> str:
    value = medians[name]
    if median_as_text:
        return S.string(as_text(value))
    return S.double(value if value is None else float(value))


def _with_medians(rows: DataFrame, df: DataFrame, names: list[str], accuracy: int) -> DataFrame:
    """Approximate medians beside rows that have a ``column`` each (a row for each column of ``df``)."""
    median = approx_quantiles(df, names, 0.5, accuracy).select(F.col("column").alias("__c"), F.col("value").alias("median"))
    return rows.join(median, rows["column"] == median["__c"], "left").drop("__c")


def statistical_analysis(df: DataFrame, columns, accuracy: int = DEFAULT_ACCURACY, exact: bool = False,
                         method: str = "linear", median_as_text: bool = False) -> DataFrame:
    """Mean, median and sample stddev per column.

    The median comes from mergeable sketches (bounded memory, rank error at most
    ``n / accuracy`` with 99 % confidence, merged in two levels) unless ``exact=True``:
    then it is the exact median by radix selection, whose number of jobs does not grow with the
    columns; ``method`` ``"linear"`` averages the two middle values, ``"lower"`` takes the
    lower one. ``median_as_text`` gives the exact median as text in the column's own type,
    so that a bigint or decimal keeps every digit.
    """
    names = _names(df, columns, "numeric")
    if median_as_text and not exact:
        raise ValueError("median_as_text needs exact=True")
    medians = {n: v[0] for n, v in exact_quantiles_many(df, names, [0.5], method, accuracy).items()} if exact else {}

    def build(i, n):
        x = S.as_double(n, df.schema[n].dataType)
        fields = [("column", S.string(n)), ("mean", f"m{i}"), ("stddev", f"s{i}")]
        if exact:
            fields.insert(2, ("median", _median_sql(medians, n, median_as_text)))
        return [f"avg({x}) AS m{i}", f"stddev({x}) AS s{i}"], [S.named_struct(fields)]
    rows = fused_rows(df, names, build)
    return rows if exact else _with_medians(rows, df, names, accuracy).select("column", "mean", "median", "stddev")


def value_counts(df: DataFrame, columns=None) -> DataFrame:
    """``(column, value, count)`` for all listed (default: string) columns.

    One ``groupBy(value).count()`` per column, unioned into one job: each branch reads
    only its own column from the scan, and its map-side partial step collapses frequent
    values before the shuffle. Values are returned as text; NULL is a value.
    """
    names = _names(df, columns, "string")
    if not names:
        raise ValueError("no columns to count")
    return union_all([
        df.groupBy(col(n).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit(n).alias("column"), "value", "count") for n in names])


def distinct_counts(df: DataFrame, columns=None, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """``(column, non_null_count, distinct_count)`` per column.

    ``distinct_count`` excludes NULL. Exact counts are one single-distinct aggregation
    per column, unioned into one job: each branch reads one column and shuffles its
    partially de-duplicated values. No row is replicated, whatever the number of columns.
    ``approx=True`` uses HyperLogLog++ in one pass without a shuffle (relative error
    ``rsd``), the cheaper choice for wide tables. Map columns (not comparable) are
    skipped by default and rejected when listed.
    """
    if columns is None:
        names = [n for n in df.columns if TY.is_orderable(df.schema[n].dataType)]
    else:
        names = _names(df, columns)
        bad = [n for n in names if not TY.is_orderable(df.schema[n].dataType)]
        if bad:
            raise ValueError(f"distinct counts cannot use map columns {bad}")
    if approx:
        return fused_rows(df, names, lambda i, n: (
            [f"count({S.ident(n)}) AS n{i}", f"approx_count_distinct({S.ident(n)}, {float(rsd)!r}) AS d{i}"],
            [S.named_struct([("column", S.string(n)), ("non_null_count", f"CAST(n{i} AS BIGINT)"),
                             ("distinct_count", f"CAST(d{i} AS BIGINT)")])]))
    return union_all([
        df.agg(F.expr(f"CAST(count({S.ident(n)}) AS BIGINT) AS non_null_count"),
               F.expr(f"CAST(count(DISTINCT {S.ident(n)}) AS BIGINT) AS distinct_count"))
        .select(F.lit(n).alias("column"), "non_null_count", "distinct_count") for n in names])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column (NULL is one value)."""
    return df.select(col(resolve(df, column))).distinct()


def duplicate_count(df: DataFrame, subset=None) -> DataFrame:
    """``(total, distinct_rows, duplicate_count)`` over full rows or ``subset``.

    See ``checks.key_counts``: digests of the rows are counted, and whole rows compared where a
    digest repeats. NULLs and NaNs group together as in ``distinct``; partial steps collapse
    repeated rows before each shuffle, so one row repeated a billion times costs one row per task.
    """
    names = _names(df, subset)
    kc = key_counts(df, names)
    return kc.select("total", F.col("distinct_keys").alias("distinct_rows"),
                     (F.col("total") - F.col("distinct_keys")).alias("duplicate_count"))


def profile(df: DataFrame, columns=None, accuracy: int = DEFAULT_ACCURACY, approx_distinct: bool = False,
            exact_median: bool = False, median_as_text: bool = False) -> DataFrame:
    """One row per column with type, counts, distinct count, range and moments.

    ``(column, data_type, nullable, rows, nulls, nans, distinct, min, max, mean, stddev,
    skewness, kurtosis, median)``; ``min``/``max`` are text of the column's own type, so
    that every type fits one column and bigint and decimal keep every digit; moments and median are for numeric columns only. The median
    comes from mergeable sketches unless ``exact_median=True``: the exact lower median by radix
    selection, as text in the column's own type with ``median_as_text``.

    Aggregations joined on the column name (k rows each): every regular metric in one pass, the
    distinct counts (``distinct_counts``) and the sketches in others. Mixing them in one aggregate
    would make Spark evaluate the regular aggregates once per distinct value.
    """
    names = _names(df, columns)
    if median_as_text and not exact_median:
        raise ValueError("median_as_text needs exact_median=True")
    numeric = [n for n in names if TY.is_numeric(df.schema[n].dataType)]
    medians = {}
    if exact_median:
        medians = {n: v[0] for n, v in exact_quantiles_many(df, numeric, [0.5], "lower", accuracy).items()}

    def build(i, n):
        f = df.schema[n]
        dt, q = f.dataType, S.ident(n)
        aggs = [f"count_if({q} IS NULL) AS nu{i}",
                (f"count_if(isnan({q}))" if TY.is_floating(dt) else "CAST(0 AS BIGINT)") + f" AS na{i}"]
        if TY.is_orderable(dt):
            v = S.extreme_value(n, dt)
            aggs += [f"CAST(min({v}) AS STRING) AS lo{i}", f"CAST(max({v}) AS STRING) AS hi{i}"]
        else:
            aggs += [f"CAST(NULL AS STRING) AS lo{i}", f"CAST(NULL AS STRING) AS hi{i}"]
        if TY.is_numeric(dt):
            x = S.as_double(n, dt)
            aggs += [f"avg({x}) AS m{i}", f"stddev({x}) AS s{i}", f"skewness({x}) AS sk{i}",
                     f"kurtosis({x}) AS ku{i}"]
        else:
            aggs += [f"CAST(NULL AS DOUBLE) AS {p}{i}" for p in ("m", "s", "sk", "ku")]
        median = _median_sql(medians, n, median_as_text) if n in medians else f"CAST(NULL AS {'STRING' if median_as_text else 'DOUBLE'})"
        return aggs, [S.named_struct([
            ("column", S.string(n)), ("data_type", S.string(dt.simpleString())),
            ("nullable", S.boolean(f.nullable)), ("rows", "CAST(rows AS BIGINT)"),
            ("nulls", f"CAST(nu{i} AS BIGINT)"), ("nans", f"CAST(na{i} AS BIGINT)"),
            ("min", f"lo{i}"), ("max", f"hi{i}"), ("mean", f"CAST(m{i} AS DOUBLE)"),
            ("stddev", f"CAST(s{i} AS DOUBLE)"), ("skewness", f"CAST(sk{i} AS DOUBLE)"),
            ("kurtosis", f"CAST(ku{i} AS DOUBLE)")] + ([("median", median)] if exact_median else []))]
    regular = fused_rows(df, names, build, shared=["count(1) AS rows"])
    if not exact_median:
        regular = _with_medians(regular, df, numeric, accuracy) if numeric else regular.withColumn("median", F.lit(None).cast("double"))
    orderable = [n for n in names if TY.is_orderable(df.schema[n].dataType)]
    if orderable:
        distinct = distinct_counts(df, orderable, approx=approx_distinct).select(
            F.col("column").alias("__c"), F.col("distinct_count").alias("distinct"))
        joined = regular.join(distinct, regular["column"] == distinct["__c"], "left")
    else:
        joined = regular.withColumn("distinct", F.lit(None).cast("long"))
    return joined.select("column", "data_type", "nullable", "rows", "nulls", "nans", "distinct", "min", "max",
                         "mean", "stddev", "skewness", "kurtosis", "median")


QUALITY_SCHEMA = "column string, metric string, value double"


def quality_report(df: DataFrame, n_std_dev: float = 3.0, ts_lo="1900-01-01 00:00:00", ts_hi=None,
                   ts_format: str = "%Y-%m-%d %H:%M:%S", include_duplicates: bool = True) -> DataFrame:
    """``(column, metric, value)`` for every column, plus one duplicate row.

    Metrics: ``null_count`` for all columns; ``timestamp_issues`` (NULL, before
    ``ts_lo``, after ``ts_hi`` = now) and ``format_issues`` for timestamp columns;
    ``outlier_issues`` (beyond ``n_std_dev`` sample stddevs) and ``skewness`` for numeric
    columns; ``duplicate_count`` over full rows with ``column`` NULL.

    Two passes over the input:

    1. one aggregation of every single-pass metric plus mean/stddev of the numeric
       columns; this one row of numbers is all that reaches the driver;
    2. one plain aggregation of the kσ outlier counts, with the bounds from pass 1 as literals,
       and beside it the duplicate count (``checks.key_counts``: row digests are shuffled, whole
       rows only where a digest repeats).
    """
    numeric = TY.columns_of(df, "numeric")
    stamps = set(TY.columns_of(df, "timestamp"))
    single, order = [], []          # pass-1 aggregate text and (column, metric, alias)
    for i, n in enumerate(df.columns):
        dt, q = df.schema[n].dataType, S.ident(n)
        metrics = [("null_count", f"count_if({q} IS NULL)")]
        if n in stamps:
            metrics += [("timestamp_issues", f"count_if({S.timestamp_implausible(n, dt, ts_lo, ts_hi)})"),
                        ("format_issues", f"count_if({q} IS NULL)")]
        if n in numeric:
            x = S.as_double(n, dt)
            metrics += [("skewness", f"skewness({x})"), ("__mean", f"avg({x})"), ("__stddev", f"stddev({x})")]
        for j, (m, e) in enumerate(metrics):
            single.append(f"{e} AS v{i}_{j}")
            order.append((n, m, f"v{i}_{j}"))
    values = {}
    for start_ in range(0, len(single), MAX_AGGS):
        row = df.agg(*[F.expr(a) for a in single[start_:start_ + MAX_AGGS]]).first().asDict()
        values.update(row)
    stats = {n: {} for n in numeric}
    literal_rows = []
    for n, m, alias in order:
        v = values[alias]
        if m in ("__mean", "__stddev"):
            stats[n][m[2:]] = v
        else:
            literal_rows.append((n, m, None if v is None else float(v)))
    spark = df.sparkSession
    out = spark.createDataFrame(literal_rows, QUALITY_SCHEMA)
    outlier_preds = [(n, S.sigma_outlier(S.as_double(n, df.schema[n].dataType), stats[n], n_std_dev))
                     for n in numeric]
    if include_duplicates:
        bad = [n for n in df.columns if not TY.is_orderable(df.schema[n].dataType)]
        if bad:
            raise ValueError(f"duplicate count cannot use map columns {bad}; pass include_duplicates=False")
        kc = key_counts(df, df.columns)
        out = out.unionByName(kc.select(F.lit(None).cast("string").alias("column"), F.lit("duplicate_count").alias("metric"),
                                        (F.col("total") - F.col("distinct_keys")).cast("double").alias("value")))
    items = [(n, "outlier_issues", f"count_if({p})") for n, p in outlier_preds]
    if items:
        pass2 = fused_rows(df, items, lambda i, it: (
            [f"{it[2]} AS o{i}"],
            [S.named_struct([("column", S.string(it[0])), ("metric", S.string(it[1])),
                             ("value", f"CAST(coalesce(o{i}, 0) AS DOUBLE)")])]))
        out = out.unionByName(pass2)
    return out


__all__ = [
    "row_count", "null_counts", "describe", "skew_kurt", "skewness", "statistical_analysis",
    "value_counts", "distinct_counts", "distinct_values", "duplicate_count", "profile",
    "quality_report",
]
