"""Data checks (V1-V11) fused into as few Spark jobs as possible.

A check is a small spec: either a row predicate that is TRUE for a failing row, or a
key whose repeated values fail (uniqueness, duplicates). ``run_checks`` puts every
predicate check of a list into **one** aggregation over the input (``count_if`` per
predicate: one scan, a map-side partial count per task, one row per task to merge).
Each key check is a branch of its own whose shuffle carries only a digest of the key
and a count (repeated keys collapse before the shuffle; see ``key_counts``). Checks that need statistics
of the data (kσ outliers) get them from one small aggregate job first, as literals.

The result is a DataFrame with ``RESULT_SCHEMA`` rows (one per check), never a raised
exception: see ``results.raise_on_failure`` / ``results.alerts`` for those uses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as P
from ..functions import sqltext as S
from ..functions import types as TY
from ..functions.names import col, resolve
from ..functions.stats import as_double, column_stats, sigma_outlier
from .fuse import fused_rows, union_all
from .results import RESULT_SCHEMA


@dataclass(frozen=True)
class Check:
    """One check: ``bad`` row predicate, or ``distinct_of`` key columns."""

    check: str
    column: str | None
    metric: str
    bad: Column | None = None
    distinct_of: tuple[str, ...] | None = None
    severity: str = "error"
    description: str = ""

    def __post_init__(self):
        if (self.bad is None) == (self.distinct_of is None):
            raise ValueError("a check needs exactly one of bad= or distinct_of=")


# ---------------------------------------------------------------------------
# check constructors

def completeness(df: DataFrame, columns=None, severity: str = "error") -> list[Check]:
    """V2: NULL values, and NaN in float/double columns, per column."""
    names = [resolve(df, c) for c in (columns or df.columns)]
    return [Check("completeness", n, "missing_count",
                  bad=P.is_missing(col(n), df.schema[n].dataType),
                  severity=severity, description=f"Column {n} contains missing values")
            for n in names]


def consistency(df: DataFrame, column1: str, column2: str, null_safe: bool = False, severity: str = "error") -> Check:
    """V3: rows where two columns differ (a text side is ``try_cast`` to the other type)."""
    a, b = resolve(df, column1), resolve(df, column2)
    ca, cb = P.comparable_pair(df, a, b)
    return Check("consistency", f"{a},{b}", "mismatch_count", bad=P.differs(ca, cb, null_safe),
                 severity=severity, description=f"Inconsistent data between columns {a} and {b}")


def value_range(df: DataFrame, column: str, min_value=None, max_value=None, severity: str = "error") -> Check:
    """V4: values outside the closed range ``[min_value, max_value]``."""
    n = resolve(df, column)
    return Check("value_range", n, "out_of_range_count", bad=P.outside(col(n), min_value, max_value),
                 severity=severity, description=f"Column {n} lies partly outside [{min_value}, {max_value}]")


def uniqueness(df: DataFrame, columns, severity: str = "error") -> Check:
    """V5: rows beyond the first of each key value (NULL counts as one value)."""
    names = tuple(resolve(df, c) for c in ([columns] if isinstance(columns, str) else columns))
    label = ",".join(names)
    return Check("uniqueness", label, "duplicate_count", distinct_of=names,
                 severity=severity, description=f"Column {label} repeats key values")


def duplicates(df: DataFrame, subset=None, severity: str = "error") -> Check:
    """G8 as a check: excess rows over the distinct rows (all columns by default)."""
    names = tuple(resolve(df, c) for c in (subset or df.columns))
    return Check("duplicates", None if subset is None else ",".join(names), "duplicate_count",
                 distinct_of=names, severity=severity, description="Duplicate rows found")


def transformation(df: DataFrame, column: str, expected, null_safe: bool = False,
                   tolerance: float | None = None, severity: str = "error") -> Check:
    """V6: rows where ``column`` differs from the expected value or Column expression.

    By default a NULL on either side passes (SQL ``!=``); ``null_safe=True`` also flags a
    NULL on one side. ``tolerance`` compares numbers with an absolute tolerance; NaN equals NaN, and
    an infinity equals itself.
    """
    n = resolve(df, column)
    exp = expected if isinstance(expected, Column) else F.lit(expected)
    if tolerance is not None:
        bad = P.differs(col(n), exp, False) & (F.abs(col(n) - exp) > F.lit(tolerance))
        if null_safe:
            bad = bad | (col(n).isNull() != exp.isNull())
    else:
        bad = P.differs(col(n), exp, null_safe)
    return Check("transformation", n, "mismatch_count", bad=bad,
                 severity=severity, description=f"Derived column {n} differs from its expression")


def allowed_values(df: DataFrame, column: str, values, allow_null: bool = True, severity: str = "error") -> Check:
    """V7: values not in ``values`` (NULL entries of the list are ignored)."""
    n = resolve(df, column)
    return Check("allowed_values", n, "invalid_count", bad=P.not_in(col(n), values, allow_null),
                 severity=severity, description=f"Column {n} has values outside the allowed set")


def timestamp_range(df: DataFrame, column: str, lo="1900-01-01 00:00:00", hi=None, severity: str = "error") -> Check:
    """V8: NULL timestamps, or timestamps before ``lo`` / after ``hi`` (default now)."""
    n = resolve(df, column)
    dt = TY.require(df, n, TY.is_datetime, "a timestamp or date")
    return Check("timestamp_range", n, "invalid_count", bad=P.timestamp_implausible(col(n), dt, lo, hi),
                 severity=severity, description=f"Column {n} has missing or implausible timestamps")


def timestamp_format(df: DataFrame, column: str, fmt: str = "%Y-%m-%d %H:%M:%S", severity: str = "error") -> Check:
    """V9: text that does not parse with the strptime-style ``fmt`` (NULL counts)."""
    n = resolve(df, column)
    return Check("timestamp_format", n, "invalid_count",
                 bad=P.timestamp_text_invalid(col(n), df.schema[n].dataType, fmt),
                 severity=severity, description=f"Column {n} has values not in format {fmt}")


def timestamp_checks(df: DataFrame, lo="1900-01-01 00:00:00", hi=None,
                     fmt: str = "%Y-%m-%d %H:%M:%S", severity: str = "error") -> list[Check]:
    """V8 and V9 for every timestamp column."""
    out = []
    for n in TY.columns_of(df, "timestamp"):
        out += [timestamp_range(df, n, lo, hi, severity), timestamp_format(df, n, fmt, severity)]
    return out


def numeric_stats(df: DataFrame, names: list[str]) -> dict[str, dict]:
    """mean/stddev/min/max/count of numeric columns from one small job (see ``column_stats``)."""
    for n in names:
        TY.require(df, n, TY.is_numeric, "numeric")
    return column_stats(df, list(names))


def outliers(df: DataFrame, column: str, n_std_dev: float = 3.0, stats: dict | None = None, severity: str = "error") -> Check:
    """Values strictly outside ``mean ± n_std_dev · sample stddev``.

    The statistics come from one small aggregate job (pass ``stats`` from
    ``numeric_stats`` to share it between checks); the bounds enter the check as
    literals. NaN is treated as missing for the statistics and never flagged; with no
    bounds (no values or one value) nothing is flagged.
    """
    n = resolve(df, column)
    dt = TY.require(df, n, TY.is_numeric, "numeric")
    st = (stats if stats is not None else numeric_stats(df, [n]))[n]
    bad = sigma_outlier(as_double(col(n), dt), st, n_std_dev)
    return Check("outliers", n, "outlier_count", bad=bad,
                 severity=severity, description=f"Column {n} has values beyond {n_std_dev} standard deviations")


# ---------------------------------------------------------------------------
# execution

def _result_row(ch: Check, order: int, failing: str, total: str) -> str:
    """SQL text of one result row; ``failing`` / ``total`` are SQL over the counts row."""
    f, t = f"CAST({failing} AS BIGINT)", f"CAST({total} AS BIGINT)"
    return S.named_struct([
        ("__order", str(order)),
        ("check", S.string(ch.check)), ("column", S.string(ch.column)), ("metric", S.string(ch.metric)),
        ("failing", f), ("total", t),
        ("value", f"try_divide(CAST({f} AS DOUBLE), CAST({t} AS DOUBLE))"),
        ("status", f"CASE WHEN {f} > 0 THEN 'fail' ELSE 'pass' END"),
        ("severity", f"CASE WHEN {f} > 0 THEN {S.string(ch.severity)} ELSE 'info' END"),
        ("message", f"concat({S.string((ch.description or ch.check) + ': ')}, CAST({f} AS STRING), ' of ', "
                    f"CAST({t} AS STRING), ' rows')"),
    ])


#: Bytes of a key (by its types) up to which it is grouped as it is: a digest would be no narrower.
NARROW_KEY = 16


def _is_narrow(df: DataFrame, key: list[str]) -> bool:
    size = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4}
    types = [df.schema[c].dataType for c in key]
    fixed = all(TY.is_numeric(t) or TY.is_datetime(t) or isinstance(t, T.BooleanType) for t in types)
    return fixed and sum(16 if isinstance(t, T.DecimalType) and t.precision > 18 else size.get(type(t), 8) for t in types) <= NARROW_KEY


def key_counts(df: DataFrame, key: tuple[str, ...] | list[str]) -> DataFrame:
    """One row ``(total, distinct_keys)``: rows and distinct values of ``key`` (NULL is a value).

    A key of a few numbers is grouped as it is. Of a wider key, rows or texts included, only a
    64-bit digest with a count goes through the shuffle. A digest that occurs once is a distinct key;
    keys whose digest repeats are read again and compared whole, so unequal keys of equal digest are told
    apart. Partial aggregates collapse repeated keys before each shuffle: a key holding a third of the
    rows costs one row per task. Repeated digests are sent to the rows where Spark finds them small, else
    both meet by digest.
    """
    key = list(key)
    bad = [c for c in key if not TY.is_orderable(df.schema[c].dataType)]
    if bad:
        raise ValueError(f"duplicate checks cannot use map columns {bad}")
    if _is_narrow(df, key):
        per_key = df.groupBy(*[col(c) for c in key]).agg(F.count(F.lit(1)).alias("__tw_n"))
        return per_key.agg(F.coalesce(F.sum("__tw_n"), F.lit(0)).cast("long").alias("total"),
                           F.count(F.lit(1)).alias("distinct_keys"))
    parts = [col(c).alias(f"k{i}") for i, c in enumerate(key)]
    rows = df.select(F.xxhash64(*[col(c) for c in key]).alias("digest"), *parts)
    digests = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    again = digests.filter("n > 1").select(F.col("digest").alias("again"))
    whole = rows.join(again, rows["digest"] == again["again"], "left_semi").groupBy(*[f"k{i}" for i in range(len(key))]).agg(F.lit(1).alias("one"))
    once = digests.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count_if(F.col("n") == 1).alias("distinct_keys"))
    more = whole.agg(F.lit(0).cast("long").alias("total"), F.count(F.lit(1)).alias("distinct_keys"))
    return once.unionByName(more).agg(F.sum("total").cast("long").alias("total"), F.sum("distinct_keys").cast("long").alias("distinct_keys"))


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Run all checks; one ``RESULT_SCHEMA`` row per check.

    All predicate checks share **one** aggregation (one scan, map-side partial counts, a
    single row per task to merge; split in batches of ``fuse.MAX_AGGS`` on very long
    check lists). Each key check (uniqueness / duplicates) is one
    ``key_counts`` branch. The branches are unioned into one result.
    """
    checks = [c for item in checks for c in (item if isinstance(item, list) else [item])]
    if not checks:
        raise ValueError("no checks given")
    branches = []
    preds = [(i, c) for i, c in enumerate(checks) if c.bad is not None]
    if preds:
        branches.append(fused_rows(df, preds, lambda j, ic: (
            [F.count_if(ic[1].bad).alias(f"__f{ic[0]}")],
            [_result_row(ic[1], ic[0], f"__f{ic[0]}", "__total")]),
            shared=["count(1) AS __total"]))
    for i, c in enumerate(checks):
        if c.distinct_of is not None:
            kc = key_counts(df, c.distinct_of)
            branches.append(kc.selectExpr(f"inline(array({_result_row(c, i, 'total - distinct_keys', 'total')}))"))
    return union_all(branches).select(*[F.col(f.name).cast(f.dataType) for f in RESULT_SCHEMA.fields])


def failing_rows(df: DataFrame, check: Check, n: int = 20, order_by=None) -> DataFrame:
    """A sample of up to ``n`` failing rows of a predicate check.

    With ``order_by`` the sample is the first ``n`` in that order (a per-partition top-n
    merged on the driver side of the plan, so only ``n`` rows per task move).
    """
    if check.bad is None:
        keys = [col(c) for c in check.distinct_of]
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
        rows = counted.filter(F.col("occurrences") > 1)
    else:
        rows = df.filter(check.bad)
    if order_by is not None:
        rows = rows.orderBy(*([order_by] if isinstance(order_by, (str, Column)) else order_by))
    return rows.limit(n)


def failing_rows_all(df: DataFrame, checks: list[Check], n: int = 20, order_by=None) -> DataFrame:
    """S4 for a list of checks: ``(check, column, place, row)`` with up to ``n`` failing rows of each.

    The sample (``failing_sample``) is taken when this is called, and its ``n`` rows a check are returned.
    """
    sample = failing_sample(df, checks, n, order_by)
    return df.sparkSession.createDataFrame(sample.collect(), sample.schema)


def failing_sample(df: DataFrame, checks: list[Check], n: int = 20, order_by=None) -> DataFrame:
    """The plan of ``failing_rows_all``.

    The sample is the first ``n`` rows in the order of a digest of the row (or of ``order_by``), so it
    is the same in every run. All predicate checks share one scan: a row goes to each check that it
    fails, and every task keeps its first ``n`` rows of a check before any row is shuffled. A key check
    (uniqueness, duplicates) gives the rows whose key repeats, found by a join with the repeated keys.
    ``place`` counts from 1; rows equal in the order and in all columns are interchangeable.
    """
    checks = [c for item in checks for c in (item if isinstance(item, list) else [item])]
    if not checks:
        raise ValueError("no checks given")
    whole = F.struct(*[col(c) for c in df.columns]).alias("row")
    if order_by is None:
        order = F.struct(F.xxhash64(*[col(c) for c in df.columns if TY.is_orderable(df.schema[c].dataType)]).alias("digest"))
    else:
        listed = [order_by] if isinstance(order_by, (str, Column)) else order_by
        order = F.struct(*[(col(resolve(df, c)) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(listed)])
    parts, preds = [], [(i, c) for i, c in enumerate(checks) if c.bad is not None]
    if preds:
        fails = F.filter(F.array(*[F.when(c.bad, F.lit(i)) for i, c in preds]), lambda i: i.isNotNull())
        parts.append(df.select(F.explode(fails).alias("i"), order.alias("o"), whole))
    for i, c in enumerate(checks):
        if c.distinct_of is not None:
            keys = [col(k).alias(f"k{j}") for j, k in enumerate(c.distinct_of)]
            again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
            rows = df.select(*keys, order.alias("o"), whole).alias("a")
            same = [F.col(f"a.k{j}").eqNullSafe(F.col(f"b.k{j}")) for j in range(len(keys))]
            parts.append(rows.join(again.alias("b"), same, "left_semi").select(F.lit(i).alias("i"), "o", "row"))
    place = F.row_number().over(Window.partitionBy("i").orderBy("o"))
    first = union_all(parts).withColumn("place", place).filter(F.col("place") <= n)
    names = [F.array(*[F.lit(x) for x in xs]) for xs in ([c.check for c in checks], [c.column for c in checks])]
    return first.select(F.get(names[0], F.col("i")).alias("check"), F.get(names[1], F.col("i")).alias("column"), "place", "row")


# ---------------------------------------------------------------------------
# V1 schema

def schema_diff(df: DataFrame, expected: T.StructType, check_nullable: bool = False,
                check_order: bool = False) -> list[tuple]:
    """Compare the frame's schema with ``expected`` (driver-side metadata, no job).

    Returns ``(column, expected_type, actual_type, status)`` tuples with status
    ``ok``, ``missing``, ``unexpected``, ``type_mismatch``, ``nullable_mismatch`` or
    ``order_mismatch``. Names compare exactly; nested types compare fully (incl. the
    nullability of array elements / map values).
    """
    actual = df.schema
    exp = {f.name: f for f in expected.fields}
    act = {f.name: f for f in actual.fields}
    out = []
    for name, f in exp.items():
        a = act.get(name)
        if a is None:
            out.append((name, f.dataType.simpleString(), None, "missing"))
        elif a.dataType != f.dataType:
            out.append((name, f.dataType.simpleString(), a.dataType.simpleString(), "type_mismatch"))
        elif check_nullable and a.nullable != f.nullable:
            out.append((name, f.dataType.simpleString(), a.dataType.simpleString(), "nullable_mismatch"))
        else:
            out.append((name, f.dataType.simpleString(), a.dataType.simpleString(), "ok"))
    for name, a in act.items():
        if name not in exp:
            out.append((name, None, a.dataType.simpleString(), "unexpected"))
    if check_order:
        common_e = [f.name for f in expected.fields if f.name in act]
        common_a = [f.name for f in actual.fields if f.name in exp]
        if common_e != common_a:
            out = [(c, e, a, "order_mismatch" if s == "ok" and common_e.index(c) != common_a.index(c) else s)
                   for c, e, a, s in out]
    return out


SCHEMA_DIFF_SCHEMA = T.StructType([
    T.StructField("column", T.StringType(), False),
    T.StructField("expected_type", T.StringType(), True),
    T.StructField("actual_type", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
])


def schema_match(spark: SparkSession, df: DataFrame, expected: T.StructType, **kw) -> DataFrame:
    """V1 as a DataFrame of ``schema_diff`` rows (one per column; metadata only)."""
    return spark.createDataFrame(schema_diff(df, expected, **kw), SCHEMA_DIFF_SCHEMA)
