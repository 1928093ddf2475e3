"""The data behind correlation heatmaps, histograms, density curves and box plots.

Each result is a small aggregate computed on the cluster; only a few numbers a column reach
the driver. Drawing is left to the caller (the results have a handful of rows).
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sqltext as S
from ..functions import types as TY
from ..functions.names import col, resolve
from ..functions.stats import as_double, column_stats, lit_double
from .profile import DEFAULT_ACCURACY
from .fuse import MAX_AGGS, fused_rows, union_all
from .quantiles import Key, approx_quantiles, by_kind, exact_quantiles_many, key_of, key_ranges, long_keys
from .quantiles import as_text as quantile_text


#: Column pairs whose coefficients fit one aggregation.
MAX_PAIRS = 120
#: Places of the grid that a binned density spreads values over.
DENSITY_BINS = 4096


def _numeric(df: DataFrame, columns) -> list[str]:
    if columns is None:
        names = TY.columns_of(df, "numeric")
    else:
        names = [resolve(df, c) for c in ([columns] if isinstance(columns, str) else columns)]
        for n in names:
            TY.require(df, n, TY.is_numeric, "numeric")
    if not names:
        raise ValueError("no numeric columns")
    return names


def _x(df: DataFrame, n: str) -> Column:
    return as_double(col(n), df.schema[n].dataType)


def correlation_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Pearson correlation of every column pair, ``(column_x, column_y, correlation)``.

    Pairwise-complete (a row counts for a pair when both values are present and not
    NaN); a constant column gives NULL instead of a division error. One scan at every width: up to
    ``MAX_PAIRS`` coefficients are one aggregation, whose single row gives the k×k rows; of more
    columns, tasks give blocks of co-moments (``_comoments``), which are merged.
    """
    names = _numeric(df, columns)
    if len(names) * (len(names) + 1) // 2 > MAX_PAIRS:
        return _correlations(df, names)
    xs = {n: S.as_double(n, df.schema[n].dataType) for n in names}
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]

    def build(_, ij):
        i, j = ij
        a, b = names[i], names[j]
        both = f"{xs[a]} IS NOT NULL AND {xs[b]} IS NOT NULL"
        pa, pb = f"CASE WHEN {both} THEN {xs[a]} END", f"CASE WHEN {both} THEN {xs[b]} END"
        corr = f"try_divide(covar_samp({pa}, {pb}), stddev({pa}) * stddev({pb})) AS r{i}_{j}"
        cells = [S.named_struct([("column_x", S.string(a)), ("column_y", S.string(b)), ("correlation", f"r{i}_{j}")])]
        if i != j:
            cells.append(S.named_struct([("column_x", S.string(b)), ("column_y", S.string(a)),
                                         ("correlation", f"r{i}_{j}")]))
        return [corr], cells
    return fused_rows(df, pairs, build, max_aggs=MAX_PAIRS)


def _comoments(df: DataFrame, names: list[str]) -> DataFrame:
    """``(i, j, n, mx, my, cxx, cyy, cxy)`` of every task and column pair: complete rows, means, centred sums.

    A batch of rows is a matrix; with 0 for missing values, the sums of all pairs are four matrix
    products. Values are shifted by the batch's column means, so nothing is lost to large means.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(names)
        n, mx, my, cxx, cyy, cxy = (np.zeros((k, k)) for _ in range(6))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)], axis=1)
            if not len(x):
                continue
            has = ~np.isnan(x)
            m = has.astype(float)
            shift = np.where(has, x, 0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
            x = np.where(has, x - shift, 0)
            own, sx, sxx, sxy = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            some = np.maximum(own, 1)
            dx, dy = sx / some, sx.T / some
            bx, by, bxx, byy, bxy = dx + shift[:, None], dy + shift[None, :], sxx - sx * dx, sxx.T - sx.T * dy, sxy - sx * dy
            both = np.maximum(n + own, 1)
            ex, ey, w = bx - mx, by - my, n * own / both
            cxx, cyy, cxy = cxx + bxx + ex * ex * w, cyy + byy + ey * ey * w, cxy + bxy + ex * ey * w
            mx, my, n = mx + ex * own / both, my + ey * own / both, n + own
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (i.astype(np.int32), j.astype(np.int32), *(v[i, j] for v in (n, mx, my, cxx, cyy, cxy)))],
                                         names=["i", "j", "n", "mx", "my", "cxx", "cyy", "cxy"])

    rows = df.select(*[_x(df, n).alias(f"x{i}") for i, n in enumerate(names)])
    return rows.mapInArrow(run, "i int, j int, n double, mx double, my double, cxx double, cyy double, cxy double")


def _correlations(df: DataFrame, names: list[str]) -> DataFrame:
    """Merges the tasks' blocks pair by pair (a pair has a row of every task) and gives the k×k rows."""
    fields = ("n", "mx", "my", "cxx", "cyy", "cxy")
    parts = dict(zip(fields, (
        "a.n + b.n", "a.mx + (b.mx - a.mx) * {w} * b.n", "a.my + (b.my - a.my) * {w} * b.n",
        "a.cxx + b.cxx + (b.mx - a.mx) * (b.mx - a.mx) * a.n * b.n * {w}",
        "a.cyy + b.cyy + (b.my - a.my) * (b.my - a.my) * a.n * b.n * {w}",
        "a.cxy + b.cxy + (b.mx - a.mx) * (b.my - a.my) * a.n * b.n * {w}")))
    struct = S.named_struct([(f, e.format(w="1 / greatest(a.n + b.n, 1D)")) for f, e in parts.items()])
    zero = S.named_struct([(f, "0D") for f in fields])
    k = len(names)
    # an empty table has no tasks, but its pairs have rows
    none = df.sparkSession.range(0, k * k, 1, 1).selectExpr(
        f"CAST(id div {k} AS INT) AS i", f"CAST(id % {k} AS INT) AS j", *[f"0D AS {f}" for f in fields]).filter("i <= j")
    pairs = _comoments(df, names).unionByName(none).groupBy("i", "j").agg(F.collect_list(F.struct(*fields)).alias("blocks"))
    total = pairs.selectExpr("i", "j", f"aggregate(blocks, {zero}, (a, b) -> {struct}) AS t")
    # fewer than two rows have no spread
    r = total.selectExpr("i", "j", "CASE WHEN t.n > 1 THEN try_divide(t.cxy, sqrt(t.cxx) * sqrt(t.cyy)) END AS r")
    name = "array(" + ", ".join(S.string(n) for n in names) + ")"
    cells = r.selectExpr("explode(CASE WHEN i = j THEN array(struct(i AS x, j AS y, r)) ELSE array(struct(i AS x, j AS y, r), struct(j AS x, i AS y, r)) END) AS c")
    return cells.selectExpr(f"get({name}, c.x) AS column_x", f"get({name}, c.y) AS column_y", "c.r AS correlation")


def histogram(df: DataFrame, columns=None, bins: int = 10) -> DataFrame:
    """R2: equal-width bins between each column's min and max.

    ``(column, bucket, lower, upper, count)``: a row for each bucket 1..bins of every
    column, empty buckets with count 0. The edges come from the finite values; the max
    falls in the last bucket, a constant column has everything in bucket 1, negative
    infinity counts in the first bucket and positive infinity in the last. Missing values
    are not counted. A column without finite values has NULL edges.

    Two passes: min/max of all columns (small jobs), then per column one hash aggregation
    on the bucket (reading only that column, its map-side partial step leaves at most
    ``bins`` rows per task to shuffle), unioned.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    names = _numeric(df, columns)
    stats = _finite_range(df, names)
    n_b, infinity = F.lit(bins).cast("long"), F.lit(float("inf"))
    empty = df.sparkSession.range(1, bins + 1, 1, 1).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("count"))
    branches = []
    for n in names:
        lo, hi = stats[n]
        lo_c, hi_c, x = lit_double(lo), lit_double(hi), F.col("x")
        bucket = F.lit(1).cast("long")
        if lo is not None and hi != lo:
            bucket = F.least(F.floor((x - lo_c) / (hi_c - lo_c) * n_b).cast("long") + 1, n_b)
        bucket = F.when(x == infinity, n_b).when(x == -infinity, F.lit(1).cast("long")).otherwise(bucket)
        width = (hi_c - lo_c) / n_b
        counted = (df.select(_x(df, n).alias("x")).filter(F.col("x").isNotNull())
                   .groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count")))
        full = counted.unionByName(empty).groupBy("bucket").agg(F.sum("count").alias("count"))
        branches.append(full.select(F.lit(n).alias("column"), "bucket",
                                    (lo_c + (F.col("bucket") - 1) * width).alias("lower"),
                                    (lo_c + F.col("bucket") * width).alias("upper"), "count"))
    return union_all(branches)


def _finite_range(df: DataFrame, names: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest finite value of each column, in batches of columns."""
    out: dict[str, tuple[float | None, float | None]] = {}
    for at in range(0, len(names), MAX_AGGS // 2):
        part, aggs = names[at:at + MAX_AGGS // 2], []
        for i, n in enumerate(part):
            x = S.as_double(n, df.schema[n].dataType)
            finite = f"CASE WHEN abs({x}) < CAST('Infinity' AS DOUBLE) THEN {x} END"
            aggs += [F.expr(f"min({finite}) AS lo{i}"), F.expr(f"max({finite}) AS hi{i}")]
        row = df.agg(*aggs).first()
        out |= {n: (row[f"lo{i}"], row[f"hi{i}"]) for i, n in enumerate(part)}
    return out


def _binned_density(df: DataFrame, names: list[str], stats: dict, points: int, bins: int) -> DataFrame:
    spark, rows, flat = df.sparkSession, [], []
    for i, n in enumerate(names):
        st = stats[n]
        lo, hi = st["min"], st["max"]
        if st["stddev"] and st["count"]:
            rows.append((i, lo, (hi - lo) / (bins - 1), (hi - lo) / (points - 1), st["stddev"] * st["count"] ** -0.2, st["count"]))
        else:
            flat += [(n, j, None if lo is None else lo + j * (hi - lo) / (points - 1), None) for j in range(points)]
    grid = F.broadcast(spark.createDataFrame(rows, "c int, lo double, width double, step double, h double, total long"))
    values = ", ".join(f"named_struct('c', {i}, 'x', {S.as_double(n, df.schema[n].dataType)})" for i, n in enumerate(names))
    near = df.selectExpr(f"inline(array({values}))").filter("x IS NOT NULL").join(grid, "c").selectExpr("c", "(x - lo) / width AS u")
    near = near.selectExpr("c", "u", f"least(floor(u), {bins - 2}) AS bin")
    held = near.groupBy("c", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("u") - F.col("bin")).alias("part"))
    # each value lies between two places of the grid and is shared out by its distance from them
    held = held.selectExpr("c", "inline(array(struct(bin AS place, n - part AS w), struct(bin + 1 AS place, part AS w)))").groupBy("c", "place").agg(F.sum("w").alias("w"))
    at = held.join(grid, "c").selectExpr("c", "lo", "step", "h", "total", "lo + place * width AS at", "w", f"explode(sequence(0, {points - 1})) AS point")
    z = "((at - (lo + point * step)) / h)"
    curve = at.selectExpr("c", "point", "lo + point * step AS x", f"w * exp(-0.5 * {z} * {z}) / (sqrt(2 * pi()) * total * h) AS d")
    curve = curve.groupBy("c", "point", "x").agg(F.sum("d").alias("density"))
    named = "array(" + ", ".join(S.string(n) for n in names) + ")"
    out = curve.selectExpr(f"get({named}, c) AS column", "point", "x", "density")
    return out.unionByName(spark.createDataFrame(flat, "column string, point int, x double, density double")) if flat else out


def density_curve(df: DataFrame, columns=None, points: int = 50, bins: int | None = DENSITY_BINS) -> DataFrame:
    """Gaussian kernel density on ``points`` equally spaced grid points in [min, max].

    ``(column, point, x, density)`` with Scott's bandwidth ``h = stddev · n^(-1/5)``. Values are first
    shared out over ``bins`` equally spaced places by linear binning, then the Gaussian is summed
    over these, so the work is ``rows + bins × points`` for each column; all columns share one scan. The
    error falls with the square of the places' distance in bandwidths.

    ``bins=None`` is exact: each grid point is one ``sum(exp(-((x-g)/h)²/2))`` over all rows, which
    is ``rows × points`` arithmetic. A constant or empty column gives NULL densities.
    """
    if points < 2 or (bins is not None and bins < 2):
        raise ValueError("points and bins must be >= 2")
    names = _numeric(df, columns)
    stats = column_stats(df, names)
    if bins is not None:
        return _binned_density(df, names, stats, points, bins)
    norm = 1.0 / math.sqrt(2.0 * math.pi)

    def build(i, n):
        st = stats[n]
        lo, hi, cnt, sd = st["min"], st["max"], st["count"], st["stddev"]
        h = sd * cnt ** -0.2 if sd and cnt else None
        step = (hi - lo) / (points - 1) if lo is not None else None
        x = S.as_double(n, df.schema[n].dataType)
        aggs, structs = [], []
        for j in range(points):
            g = lo + j * step if step is not None else None
            if h:
                z = f"(({x} - {S.double(g)}) / {S.double(h)})"  # squared by a product, not by pow
                aggs.append(f"sum(exp(-0.5 * {z} * {z})) AS k{i}_{j}")
                dens = f"k{i}_{j} * {S.double(norm / (cnt * h))}"
            else:
                dens = S.double(None)
            structs.append(S.named_struct([("column", S.string(n)), ("point", str(j)), ("x", S.double(g)),
                                           ("density", dens)]))
        return aggs, structs
    return fused_rows(df, names, build, shared=["count(1) AS __n"])


def _key_bounds(key: Key, q1, q3, whis: float, lo: int, hi: int) -> tuple[int, int]:
    """Least and largest key of a column (from ``lo`` to ``hi``) within the whiskers' reach."""
    if isinstance(q1, float) and TY.is_floating(key.dt):
        low, high = q1 - whis * (q3 - q1), q3 + whis * (q3 - q1)
        first = lo if math.isnan(low) else key.of(low)
        last = hi if math.isnan(high) else key.of(high)
    else:
        scale = key.dt.scale if isinstance(key.dt, T.DecimalType) else 0
        a, b = (Fraction(q) * 10 ** scale for q in (q1, q3))
        reach = Fraction(whis) * (b - a)
        first, last = math.ceil(a - reach), math.floor(b + reach)
    return max(lo, first), min(hi, last)


def box_stats(df: DataFrame, columns=None, whis: float = 1.5, exact: bool = True,
              accuracy: int = DEFAULT_ACCURACY, as_text: bool = False) -> DataFrame:
    """Box-plot statistics per column.

    ``(column, q1, median, q3, lower_whisker, upper_whisker, outliers)``. Quartiles are exact and
    linearly interpolated (as box plots draw them) by radix selection in the column's own type
    (``quantiles.exact_quantiles_many``); ``exact=False`` takes them from mergeable sketches instead.
    Whiskers are the most extreme values inside ``[q1 - whis·IQR, q3 + whis·IQR]``; ``outliers``
    counts the values outside. They come from one more job, in which every column's bounds are rows of
    a small joined table; the driver gets three numbers a column, and the number of jobs does not
    grow with the columns. Values are doubles, or with ``as_text`` texts that keep every digit of a
    bigint or decimal. Quartiles at infinity bound nothing.
    """
    names = _numeric(df, columns)
    keys = {i: key_of(df, n) for i, n in enumerate(names)}
    ranges = key_ranges(df, keys)
    probs = [0.25, 0.5, 0.75]
    if exact:
        quart = exact_quantiles_many(df, names, probs, "linear", accuracy)
    else:
        found = [{r["column"]: r["value"] for r in approx_quantiles(df, names, p, accuracy).collect()} for p in probs]
        quart = {n: [f[n] for f in found] for n in names}
    bounds = {i: _key_bounds(keys[i], quart[names[i]][0], quart[names[i]][2], whis, *ranges[i][1:]) for i in ranges}
    ends: dict[int, tuple] = {}
    for group in by_kind({i: keys[i] for i in bounds}):
        kind = next(iter(group.values())).kind
        typed = int if kind == "bigint" else Decimal
        near = F.broadcast(df.sparkSession.createDataFrame([(i, *map(typed, bounds[i])) for i in group], f"c int, first {kind}, last {kind}"))
        rows = long_keys(df, group).join(near, "c").groupBy("c").agg(
            F.min(F.when(F.col("key") >= F.col("first"), F.col("key"))).alias("low"),
            F.max(F.when(F.col("key") <= F.col("last"), F.col("key"))).alias("high"),
            F.count_if((F.col("key") < F.col("first")) | (F.col("key") > F.col("last"))).alias("outliers"))
        ends |= {r["c"]: (r["low"], r["high"], r["outliers"]) for r in rows.collect()}
    shown = quantile_text if as_text else lambda v: None if v is None else float(v)
    out = []
    for i, n in enumerate(names):
        low, high, outliers = ends.get(i, (None, None, 0))
        whiskers = [None if k is None else keys[i].value(int(k)) for k in (low, high)]
        out.append((n, *[shown(v) for v in (*quart[n], *whiskers)], outliers))
    kind = "string" if as_text else "double"
    return df.sparkSession.createDataFrame(
        out, f"column string, q1 {kind}, median {kind}, q3 {kind}, lower_whisker {kind}, upper_whisker {kind}, outliers long")
