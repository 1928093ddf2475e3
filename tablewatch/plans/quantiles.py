"""Exact quantiles of numeric columns by radix selection, and approximate ones by mergeable sketches.

Selection works on whole-number keys that keep the order of a column's own type: integers are
their own keys, decimals their digits without the point, doubles their sign, exponent and fraction
bits. Nothing is rounded, so every digit of a bigint or a wide decimal is kept.

All columns are read as rows ``(column, key)``. A first job counts the keys of every column with
their least and largest one. Each further job cuts the open ranges of all columns into at most
``accuracy`` equal parts, counts the keys of every part, and takes the part that each wanted rank
falls into, with its least and largest key, until these are one: four or five jobs for doubles of
any spread, one where values are few. The open ranges are a small table that is joined; the number of jobs does not grow with
the number of columns or ranks, and the driver gets one row a rank. A range of at most
``collect_limit`` keys is counted key by key. Counting is partial in every task, so a value that
fills a third of the column costs one row a task.
"""

from __future__ import annotations

import decimal
import math
import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sqltext as S
from ..functions import types as TY
from ..functions.names import resolve
from .fuse import MAX_AGGS, union_all

#: Parts of a range in one round, and keys of a range that are counted one by one.
DEFAULT_PARTS = 4096
DEFAULT_COLLECT_LIMIT = 4096
_FRACTION = 1 << 52
_LEAST_NORMAL, _LEAST = 2.2250738585072014e-308, 5e-324


@dataclass(frozen=True)
class Key:
    """Order-preserving key of one column: SQL text (for doubles, of the value), the key's type
    (``bigint`` or ``decimal(38,0)``) and the column's type."""
    sql: str
    kind: str
    dt: T.DataType

    def value(self, key: int):
        """The value of a key, in the column's own type."""
        if TY.is_floating(self.dt):
            return math.copysign(struct.unpack(">d", struct.pack(">Q", abs(key)))[0], key)
        if isinstance(self.dt, T.DecimalType):
            return decimal.Decimal(key).scaleb(-self.dt.scale, decimal.Context(prec=80))
        return key

    def of(self, value: float) -> int:
        """The key of a double."""
        bits = struct.unpack(">q", struct.pack(">d", abs(value)))[0]
        return -bits if value < 0 else bits


def _exponent(x: str) -> str:
    """Power of two at or next to that of a double."""
    return f"CAST(floor(log2(abs({x}))) AS DOUBLE)"


def _power(x: str, e: str) -> str:
    """The power itself: a logarithm that rounds to the wrong one is put right."""
    return f"{e} + CASE WHEN abs({x}) < pow(2D, {e}) THEN -1 WHEN abs({x}) >= 2 * pow(2D, least({e}, 1023D)) THEN 1 ELSE 0 END"


def _double_key(x: str, power: str) -> str:
    """Sign and IEEE bits of a double as a whole number, by exact arithmetic: powers of two, and
    quotients by them, are exact."""
    normal = f"CAST({power} + 1023 AS BIGINT) * {_FRACTION} + CAST((abs({x}) / pow(2D, {power}) - 1) * {_FRACTION} AS BIGINT)"
    return (f"CASE WHEN {x} < 0 THEN -1 ELSE 1 END * CASE WHEN abs({x}) = CAST('Infinity' AS DOUBLE) THEN {2047 * _FRACTION} "
            f"WHEN abs({x}) >= {S.double(_LEAST_NORMAL)} THEN {normal} ELSE CAST(abs({x}) / {S.double(_LEAST)} AS BIGINT) END")


def key_of(df: DataFrame, name: str) -> Key:
    """Key of a numeric column; NULL and NaN have none."""
    dt = TY.require(df, name, TY.is_numeric, "numeric")
    q = S.ident(name)
    if TY.is_floating(dt):
        return Key(S.as_double(name, dt), "bigint", dt)
    if isinstance(dt, T.DecimalType):
        if dt.precision <= 18:
            return Key(f"CAST({q} * CAST('{10 ** dt.scale}' AS DECIMAL(19,0)) AS BIGINT)", "bigint", dt)
        if dt.scale > 17:  # as text, which ANSI mode writes without exponent
            return Key(f"CAST(replace(CAST({q} AS STRING), '.', '') AS DECIMAL(38,0))", "decimal(38,0)", dt)
        ten, whole = f"CAST('{10 ** dt.scale}' AS DECIMAL({dt.scale + 1},0))", max(1, dt.precision - dt.scale)
        return Key(f"CAST(CAST({q} - {q} % 1 AS DECIMAL({whole},0)) * {ten} + CAST({q} % 1 * {ten} AS DECIMAL(38,0)) AS DECIMAL(38,0))",
                   "decimal(38,0)", dt)
    return Key(f"CAST({q} AS BIGINT)", "bigint", dt)


def long_keys(df: DataFrame, keys: dict[int, Key]) -> DataFrame:
    """``(c, key)`` rows of columns of one kind, without NULL and NaN: one scan of those columns."""
    doubles = [c for c, k in keys.items() if TY.is_floating(k.dt)]
    rows = df.selectExpr(*[f"{k.sql} AS k{c}" for c, k in keys.items()])
    if doubles:  # step by step, so that each part is worked out once
        rows = rows.selectExpr("*", *[f"{_exponent(f'k{c}')} AS e{c}" for c in doubles])
        rows = rows.selectExpr(*[f"k{c}" for c in keys], *[f"{_power(f'k{c}', f'e{c}')} AS p{c}" for c in doubles])
        rows = rows.selectExpr(*[f"{_double_key(f'k{c}', f'p{c}')} AS k{c}" if c in doubles else f"k{c}" for c in keys])
    pairs = ", ".join(f"named_struct('c', {c}, 'key', k{c})" for c in keys)
    return rows.selectExpr(f"inline(array({pairs}))").filter("key IS NOT NULL")


def by_kind(keys: dict[int, Key]) -> list[dict[int, Key]]:
    """The columns of each kind of key; a job serves all columns of a kind."""
    kinds = sorted({k.kind for k in keys.values()})
    return [{c: k for c, k in keys.items() if k.kind == kind} for kind in kinds]


def _step(lo: int, hi: int, parts: int, kind: str) -> int:
    """Power of two (of ten for decimals) that cuts the range into at most ``parts`` parts. With four
    times the base as the least number of parts, a part is always well below the range it is cut from,
    also the one around 0, which is twice as wide."""
    base, step = 2 if kind == "bigint" else 10, 1
    while (hi - lo) // step + 2 > max(parts, 4 * base):
        step *= base
    return step


def select_ranks(df: DataFrame, keys: dict[int, Key], targets: dict[int, list[int]], ranges: dict[int, tuple[int, int, int]],
                 parts: int = DEFAULT_PARTS, collect_limit: int = DEFAULT_COLLECT_LIMIT) -> dict[tuple[int, int], int]:
    """Key at each wanted 0-based rank of each column.

    ``ranges`` holds number, least and largest key of every column, ``targets`` the ranks.
    """
    spark = df.sparkSession
    answer: dict[tuple[int, int], int] = {}
    # open ranges (column, least, largest key, keys) with the ranks in them, counted from the range's start
    state = {(c, lo, hi, n): [(r, r) for r in targets[c]] for c, (n, lo, hi) in ranges.items() if targets.get(c)}
    while state:
        following: dict = {}
        for group in by_kind({c: keys[c] for c, *_ in state}):
            kind = next(iter(group.values())).kind
            number = T.LongType() if kind == "bigint" else T.DecimalType(38, 0)
            typed = int if kind == "bigint" else decimal.Decimal
            cuts, wanted = [], []
            mine = [(g, s, ranks) for g, (s, ranks) in enumerate(state.items()) if s[0] in group]
            for g, (c, lo, hi, n), ranks in mine:
                step = 1 if n <= collect_limit else _step(lo, hi, parts, kind)
                cuts.append((c, g, typed(lo), typed(hi), typed(step)))
                wanted += [(g, r, at) for r, at in ranks]
            schema = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("g", T.IntegerType())] +
                                  [T.StructField(f, number) for f in ("lo", "hi", "step")])
            cut = F.broadcast(spark.createDataFrame(cuts, schema))
            part = (F.col("key") - F.col("key") % F.col("step")).cast(number).alias("part")
            counted = (long_keys(df, group).join(cut, "c").filter("key BETWEEN lo AND hi")
                       .groupBy("g", part).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last")))
            before = F.sum("n").over(W.partitionBy("g").orderBy("part")) - F.col("n")
            ranks = F.broadcast(spark.createDataFrame(wanted, "g int, rank long, at long"))
            found = counted.withColumn("before", before).join(ranks, "g").filter("at >= before AND at < before + n")
            columns = {g: s[0] for g, s, _ in mine}
            for row in found.collect():
                c, first, last = columns[row["g"]], int(row["first"]), int(row["last"])
                if first == last:
                    answer[c, row["rank"]] = first
                else:
                    following.setdefault((c, first, last, row["n"]), []).append((row["rank"], row["at"] - row["before"]))
        state = following
    return answer


def key_ranges(df: DataFrame, keys: dict[int, Key]) -> dict[int, tuple[int, int, int]]:
    """Number, least and largest key of every column that has any: one job for all columns of a kind."""
    out = {}
    for group in by_kind(keys):
        for r in long_keys(df, group).groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect():
            out[r["c"]] = (r["n"], int(r["lo"]), int(r["hi"]))
    return out


def _ranks(n: int, probs: list[float], method: str) -> list[list[int]]:
    out = []
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"quantile {p} outside [0, 1]")
        h = (n - 1) * p
        if method == "linear":
            out.append(sorted({int(math.floor(h)), int(math.ceil(h))}))
        elif method == "lower":
            out.append([int(math.floor(h))])
        else:
            raise ValueError("method must be 'linear' or 'lower'")
    return out


def _between(lo, hi, share: float):
    """Value at a share of the way; exact for integers and decimals."""
    if isinstance(lo, float):
        return lo + (hi - lo) * share if lo != hi else lo
    exact = decimal.Context(prec=100)
    return exact.add(decimal.Decimal(lo), exact.multiply(exact.subtract(decimal.Decimal(hi), decimal.Decimal(lo)), decimal.Decimal(share)))


def exact_quantiles_many(df: DataFrame, columns, probs: list[float], method: str = "linear",
                         accuracy: int = DEFAULT_PARTS, collect_limit: int = DEFAULT_COLLECT_LIMIT) -> dict[str, list]:
    """Exact quantiles of several numeric columns at once (NULL and NaN skipped).

    ``method="linear"`` interpolates between the two neighbouring order statistics at position
    ``(n - 1)·p`` (the usual definition, as in box plots), ``method="lower"`` returns the order
    statistic at ``floor((n - 1)·p)``. Values are of the column's own type (int, Decimal or float; a
    value between two integers or decimals is an exact Decimal). An empty column gives ``None``.
    ``accuracy`` is the number of parts that a round cuts a range into.
    """
    names = [resolve(df, c) for c in columns]
    keys = {i: key_of(df, n) for i, n in enumerate(names)}
    ranges = key_ranges(df, keys) if keys else {}
    per_prob = {i: _ranks(n, probs, method) for i, (n, _, _) in ranges.items()}
    targets = {i: sorted({r for rs in per_prob[i] for r in rs}) for i in per_prob}
    found = select_ranks(df, keys, targets, ranges, accuracy, collect_limit)
    out: dict[str, list] = {}
    for i, name in enumerate(names):
        if i not in ranges:
            out[name] = [None for _ in probs]
            continue
        out[name] = []
        for p, rs in zip(probs, per_prob[i]):
            values = [keys[i].value(found[i, r]) for r in rs]
            h = (ranges[i][0] - 1) * p
            out[name].append(values[0] if len(values) == 1 else _between(*values, h - math.floor(h)))
    return out


def exact_quantiles(df: DataFrame, column: str, probs: list[float], method: str = "linear",
                    accuracy: int = DEFAULT_PARTS, collect_limit: int = DEFAULT_COLLECT_LIMIT) -> list:
    """Exact quantiles of one numeric column (see ``exact_quantiles_many``)."""
    name = resolve(df, column)
    return exact_quantiles_many(df, [name], probs, method, accuracy, collect_limit)[name]


def as_text(value) -> str | None:
    """A value of :func:`exact_quantiles_many` as text with all its digits."""
    if value is None:
        return None
    return format(value, "f") if isinstance(value, decimal.Decimal) else repr(value)


# ---------------------------------------------------------------------------
# approximate quantiles

#: Groups of tasks whose sketches are merged side by side before the last merge.
SKETCH_GROUPS = 64


def sketch_size(accuracy: int) -> int:
    """Size ``k`` of a KLL sketch whose rank error is at most ``rows / accuracy`` (with 99 % confidence).

    The error of a sketch of size k is 2.296 / k^0.9723 of the rows (published for this sketch).
    """
    return max(8, min(65535, math.ceil((2.296 * accuracy) ** (1 / 0.9723))))


def approx_quantiles(df: DataFrame, columns, p: float, accuracy: int) -> DataFrame:
    """``(column, value)``: approximate quantile of numeric columns as doubles, lazily, in one scan.

    Sketches merge in two levels: tasks are dealt to ``SKETCH_GROUPS`` groups, each group's sketches
    merge in a task of its own, and only the groups' sketches meet. A sketch holds at most some
    ``3 k`` values, so no task's memory grows with the table or the number of its tasks.
    """
    names = [resolve(df, c) for c in columns]
    k, frames = sketch_size(accuracy), []
    for at in range(0, len(names), MAX_AGGS):
        part = names[at:at + MAX_AGGS]
        xs = [S.as_double(n, TY.require(df, n, TY.is_numeric, "numeric")) for n in part]
        grouped = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("g")).agg(
            *[F.expr(f"kll_sketch_agg_double({x}, {k}) AS s{i}") for i, x in enumerate(xs)],
            *[F.expr(f"count({x}) AS n{i}") for i, x in enumerate(xs)])
        merged = grouped.agg(*[F.expr(f"kll_merge_agg_double(s{i}, {k}) FILTER (WHERE n{i} > 0) AS s{i}") for i in range(len(part))],
                             *[F.expr(f"sum(n{i}) AS n{i}") for i in range(len(part))])
        rows = [S.named_struct([("column", S.string(n)), ("value", f"CASE WHEN n{i} > 0 THEN kll_sketch_get_quantile_double(s{i}, {S.double(p)}) END")])
                for i, n in enumerate(part)]
        frames.append(merged.selectExpr("inline(array(" + ", ".join(rows) + "))"))
    return union_all(frames)
