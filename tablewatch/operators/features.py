"""Feature engineering (F1 timestamp parts, F2 one-hot indicators)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import types as TY
from ..functions import sqltext as S
from ..functions.names import col, label, resolve, unique_names
from ..sources.files import materialize


def timestamp_parts(df: DataFrame, columns=None) -> DataFrame:
    """add ``{c}_year``, ``{c}_month``, ``{c}_day``, ``{c}_hour`` (int) per timestamp column.

    ``columns`` defaults to every timestamp / timestamp_ntz column; date columns may be
    listed too (their hour is 0). One projection for all columns.
    """
    names = [resolve(df, c) for c in (columns or TY.columns_of(df, "timestamp"))]
    new = {}
    for n in names:
        TY.require(df, n, TY.is_datetime, "a timestamp or date")
        c = col(n)
        new[f"{n}_year"] = F.year(c)
        new[f"{n}_month"] = F.month(c)
        new[f"{n}_day"] = F.dayofmonth(c)
        new[f"{n}_hour"] = F.hour(c)
    return df.withColumns(new)


#: Values of a column that become columns of their own, unless the caller says otherwise.
MAX_CATEGORIES = 10_000


def category_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Number of distinct values of each column, NULL included; counted on the cluster, one row a column."""
    if not columns:
        return {}
    rows = None
    for c in columns:
        own = df.select(col(c).cast("string").alias("value")).distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("column"), "n")
        rows = own if rows is None else rows.unionByName(own)
    return {r["column"]: r["n"] for r in rows.collect()}


def category_vocabulary(df: DataFrame, columns: list[str], max_categories: int | None = MAX_CATEGORIES) -> dict[str, list]:
    """Distinct values of each column (NULL included), sorted, for all columns in one pass.

    One ``distinct`` per column (each reads only its column; a map-side partial step
    collapses repeated values), unioned into one job. The values become column names, so
    they reach the driver. They are counted on the cluster first, and columns with more than
    ``max_categories`` are refused before any value is collected (None: no limit, no count). For
    columns of unbounded vocabulary use ``one_hot_indexed`` or ``one_hot_long``, which gather none.
    """
    if not columns:
        return {}
    if max_categories is not None:
        too_many = {c: n for c, n in category_counts(df, columns).items() if n > max_categories}
        if too_many:
            raise ValueError(f"too many categories for one-hot encoding {too_many}; limit is {max_categories}")
    branches = [df.select(col(c).cast("string").alias("value")).distinct()
                .select(F.lit(c).alias("column"), "value") for c in columns]
    pairs = branches[0]
    for b in branches[1:]:
        pairs = pairs.unionByName(b)
    vocab: dict[str, list] = {c: [] for c in columns}
    for r in pairs.collect():
        vocab[r["column"]].append(r["value"])
    for c in vocab:
        vocab[c].sort(key=lambda v: (v is not None, v or ""))
    return vocab


def one_hot_long(df: DataFrame, keys, columns=None) -> DataFrame:
    """F2 in long form: ``(*keys, column, value)``, the indicators of ``one_hot`` that are 1.

    One row per input row and column, with NULL values kept. Nothing is gathered on the
    driver and nothing is shuffled, so columns of any cardinality fit.
    """
    names = [resolve(df, c) for c in (columns if columns is not None else TY.columns_of(df, "string"))]
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), col(n).cast("string").alias("value")) for n in names])
    return df.select(*[col(resolve(df, k)) for k in keys], F.inline(pairs))


def one_hot(df: DataFrame, columns=None, max_categories: int | None = MAX_CATEGORIES) -> DataFrame:
    """one int 0/1 column ``{c}_{value}`` per distinct value of each string column.

    The label is the value with spaces replaced by ``_``; a NULL value gets ``{c}_None``,
    which is 1 on the NULL rows. Labels that clash (also case-insensitively, as Spark
    resolves names) get a numeric suffix instead of overwriting each other. Columns are
    ordered by source column, then value (NULL first). The vocabulary is one small job
    (see ``category_vocabulary``); the encoding itself is a single projection.
    """
    names = [resolve(df, c) for c in (columns if columns is not None else TY.columns_of(df, "string"))]
    vocab = category_vocabulary(df, names, max_categories)
    wanted, exprs = [], []
    for n in names:
        text = f"CAST({S.ident(n)} AS STRING)"
        for v in vocab[n]:
            wanted.append(f"{n}_{label(v)}")
            exprs.append(f"CASE WHEN {text} <=> {S.string(v)} THEN 1 ELSE 0 END")
    final = unique_names(wanted, list(df.columns))
    # SQL text: one JVM call for all indicators instead of several per category
    return df.selectExpr("*", *[f"{e} AS {S.ident(a)}" for e, a in zip(exprs, final)])


#: Text of a column's dictionary, in bytes, that is sent to all rows; a larger one is joined by the values' digests.
BROADCAST_BYTES = 8 << 20


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, index)``: every distinct value of each column as text, numbered from 0 in their order, NULL first.

    The numbering is done on the cluster: distinct values are dealt by ranges, numbered within their
    partition, and moved on by the number of values in the partitions before: two numbers for each partition
    and column, which the driver adds up. The dealt values are written once to the shared folder, since ranges are found by
    sampling and must not be dealt anew.
    """
    return _numbered_values(df, [resolve(df, c) for c in columns])[0]


def _numbered_values(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """The dictionary of :func:`category_dictionary`, and about how many bytes that of each column takes."""
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), col(n).cast("string").alias("value")) for n in names]))).distinct()
    dealt = pairs.repartitionByRange(F.col("column"), F.col("value").asc_nulls_first()).sortWithinPartitions("column", F.col("value").asc_nulls_first())
    dealt = materialize(dealt.select("column", "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
                        f"categories-{uuid.uuid4().hex}")
    parts = dealt.groupBy("column", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"),
                                                F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 32).alias("bytes"))
    moves, upto, held = [], {}, dict.fromkeys(names, 0)
    for r in sorted(parts.collect(), key=lambda r: (r["column"], r["part"])):
        moves.append((r["column"], r["part"], upto.get(r["column"], 0) - r["first"]))
        upto[r["column"]] = upto.get(r["column"], 0) + r["n"]
        held[r["column"]] += r["bytes"]
    parts = df.sparkSession.createDataFrame(moves, "column string, part int, move long")
    numbered = dealt.join(F.broadcast(parts), ["column", "part"]).select("column", "value", (F.col("at") + F.col("move")).alias("index"))
    return numbered, held


def one_hot_indexed(df: DataFrame, columns=None) -> DataFrame:
    """F2 for columns of any vocabulary: add ``{c}_index`` (long), the place of the value's indicator
    among the column's sorted values (NULL first, as ``one_hot`` orders them).

    Row and index are a one-hot vector in sparse form. The dictionary is a table that is joined, column by column;
    no value reaches the driver. A dictionary of at most ``BROADCAST_BYTES`` is sent to the rows, which are not moved for it:
    by a few values they would meet in as few tasks. A larger one is joined by the values' SHA-256, so rows
    carry a long value only where the caller keeps it; Spark splits hot values of the rows there.
    """
    names = [resolve(df, c) for c in (columns if columns is not None else TY.columns_of(df, "string"))]
    if not names:
        return df
    final = unique_names([f"{n}_index" for n in names], list(df.columns))
    (dictionary, held), out = _numbered_values(df, names), df
    for n, index in zip(names, final):
        key, = unique_names(["category_key"], list(out.columns) + final)
        small, text = held[n] <= BROADCAST_BYTES, col(n).cast("string")
        own = dictionary.filter(F.col("column") == n).select(
            (F.col("value") if small else _digest(F.col("value"))).alias(key), F.col("index").alias(index))
        if small:
            out = out.join(F.broadcast(own), text.eqNullSafe(F.col(key)), "left").drop(key)
        else:
            mine, = unique_names(["row_key"], [*out.columns, *final, key])
            out = out.withColumn(mine, _digest(text)).join(own, F.col(mine).eqNullSafe(F.col(key)), "left").drop(mine, key)
    return out


def _digest(text):
    """SHA-256 of a text's UTF-8 bytes, 32 bytes; NULL for NULL."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def encode_categories(df: DataFrame, columns=None, max_categories: int | None = MAX_CATEGORIES) -> DataFrame:
    """F2 for all string columns: indicators (``one_hot``) for columns of at most ``max_categories`` values,
    an index (``one_hot_indexed``) for the others."""
    names = [resolve(df, c) for c in (columns if columns is not None else TY.columns_of(df, "string"))]
    counts = category_counts(df, names) if max_categories is not None else {}
    wide = [n for n in names if max_categories is None or counts[n] <= max_categories]
    out = one_hot(df, wide, None)
    return one_hot_indexed(out, [n for n in names if n not in wide])
