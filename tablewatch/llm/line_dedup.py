"""Operator 6: removal of repeated line runs, by prefix doubling over line ids (DataFrame functions only).

The texts are one long sequence of line ids in the order of documents and lines. Suffixes of that
sequence are put into buckets by their first 1, 2, 4, ... lines: the bucket for twice as many lines
follows from the bucket of a suffix and of the suffix so many lines later. Only buckets of two or
more suffixes go on; the others are resolved. Buckets are numbered, not sorted: what is asked of the
suffix array is its intervals of a common prefix, and these are the buckets. Two overlapping buckets
give the interval of any length.

A run of lines counts as repeated if it has ``MIN_WORDS`` words or more and stands earlier in the
corpus too, within a document or across documents; the earliest copy stays, later ones lose these
lines. Every line of a maximal repeated run lies in the shortest run of enough words from some line
on, or up to some line, that is itself repeated, so these two runs of each line are looked up. They
have ``MIN_WORDS`` lines at most, which bounds the rounds of doubling.

Lines are equal if their words are; lines without words are passed over and stay. Earlier means a
smaller id, then a smaller digest of the text, then a smaller line. Null texts stay null. Rows that
repeat an id and its text count as one document, and each gets its result. A null id comes first. A
table without rows gives none.
"""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import SPACE_CHARS, free_name, stored, words

#: Words of a run that is worth removing.
MIN_WORDS = 50
_DOC = ["doc_id", "digest"]


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest, pos, line, n``: lines with words, counted from 0, by a digest of their words."""
    worded = F.filter(F.transform(F.split(F.coalesce(df[text_col], F.lit("")), "\n"), lambda x: F.transform(
        F.array(words(x)), lambda w: F.struct(F.md5(F.array_join(w, " ").cast("binary")).alias("line"), F.size(w).alias("n")))[0]),
        lambda x: x["n"] > 0)
    return df.select(df[id_col].alias("doc_id"), _digest(df[text_col]).alias("digest"),
                     F.posexplode(worded).alias("pos", "x")).select(
        *_DOC, "pos", F.unhex("x.line").alias("line"), F.col("x.n").alias("n"))


def _buckets(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """A number for each value of ``keys`` (columns renamed ``_...``) that two rows or more have."""
    return stored(rows.groupBy(*keys).count().filter("count > 1").select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.monotonically_increasing_id().alias("number")), label)


def _doubled(at: DataFrame, levels: int) -> DataFrame:
    """Add ``b1, b2, ...``: the bucket by the first 2, 4, ... lines, null where no other suffix shares them."""
    for level in range(1, levels + 1):
        before, step = f"b{level - 1}", 2 ** (level - 1)
        later = F.max(before).over(Window.partitionBy(*_DOC).orderBy("pos").rangeBetween(step, step))
        # resolved suffixes get a key of their own below zero: none of them meets another
        none = -1 - F.col("uid")
        pairs = at.withColumn("later", later).withColumn("own", F.coalesce(F.col(before), none)).withColumn(
            "later", F.coalesce("later", none))
        numbers = _buckets(pairs.filter("own >= 0 AND later >= 0"), ["own", "later"], f"buckets-{level}")
        at = stored(pairs.join(numbers, (F.col("own") == F.col("_own")) & (F.col("later") == F.col("_later")), "left")
                    .select(*at.columns, F.col("number").alias(f"b{level}")), f"suffixes-{level}")
        if not numbers.head(1):
            for more in range(level + 1, levels + 1):
                at = at.withColumn(f"b{more}", F.lit(None).cast("long"))
            break
    return at


def _runs(at: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, digest, pos, length``: for each line the shortest run of enough words that begins
    with it, and that ends with it, if all its lines are repeated ones in a row."""
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")
    seen = at.select(*_DOC, "pos", "n", F.row_number().over(in_doc).alias("i"), F.sum("n").over(in_doc).alias("upto"))
    seen = seen.withColumn("before", F.col("upto") - F.col("n"))
    line, asks = F.lit(0).alias("kind"), F.lit(1).alias("kind")
    own = F.struct("pos", "i").alias("it")
    found = []
    for value, target, order in (
            ("upto", F.col("before") + min_words, F.col("value").desc()),  # the end of the run from here
            ("before", F.col("upto") - min_words, F.col("value"))):  # the beginning of the run up to here
        both = seen.select(*_DOC, F.col(value).alias("value"), line, own).unionByName(
            seen.select(*_DOC, target.alias("value"), asks, own))
        nearest = F.last(F.when(F.col("kind") == 0, F.col("it")), ignorenulls=True).over(
            Window.partitionBy(*_DOC).orderBy(order, "kind").rowsBetween(Window.unboundedPreceding, 0))
        near = both.withColumn("other", nearest).filter("kind = 1 AND other IS NOT NULL")
        found.append(near.filter(F.col("other.pos") - F.col("it.pos") == F.col("other.i") - F.col("it.i")).select(
            *_DOC, F.least("it.pos", "other.pos").alias("pos"),
            (F.abs(F.col("other.pos") - F.col("it.pos")) + 1).alias("length")))
    return found[0].unionByName(found[1]).distinct()


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, digest, pos``: the lines that repeat an earlier run."""
    lines = stored(_lines(df, id_col, text_col), "lines")
    shared = _buckets(lines, ["line"], "buckets-0")
    at = stored(lines.join(shared, F.col("line") == F.col("_line")).select(*_DOC, "pos", "n", F.col("number").alias("b0"))
                .dropDuplicates([*_DOC, "pos"]).withColumn("uid", F.monotonically_increasing_id()), "suffixes-0")
    levels = floor(log2(min_words)) if min_words > 1 else 0
    at = _doubled(at, levels)
    level = F.floor(F.log2("length") + F.lit(1e-9)).cast("int")
    runs = _runs(at, min_words).withColumn("level", level).withColumn(
        "second", (F.col("pos") + F.col("length") - F.pow(F.lit(2.0), F.col("level"))).cast("int"))
    bucket = F.array(*[f"b{k}" for k in range(levels + 1)])
    table = at.select(*[F.col(c).alias(f"_{c}") for c in _DOC], F.col("pos").alias("_pos"), bucket.alias("b"))
    here = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _DOC]
    for name, where in (("x", "pos"), ("y", "second")):
        runs = runs.join(table, [*here, F.col(where) == F.col("_pos")]).withColumn(
            name, F.get("b", F.col("level"))).drop("b", "_pos", *[f"_{c}" for c in _DOC])
    runs = stored(runs.filter("x IS NOT NULL AND y IS NOT NULL"), "runs")
    place = F.struct(F.col("doc_id").isNotNull().alias("has_id"), *_DOC, "pos")
    first = stored(runs.groupBy("length", "x", "y").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter(
        "n > 1").select(F.col("length").alias("_length"), F.col("x").alias("_x"), F.col("y").alias("_y"), "first"), "intervals")
    later = runs.join(first, (F.col("length") == F.col("_length")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y"))
                      ).filter(~place.eqNullSafe(F.col("first")))
    return later.select(*_DOC, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("length") - 1)).alias("pos")).distinct()


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
               removed_col: str | None = "removed_lines") -> DataFrame:
    """``df`` with the text of every row without its repeated runs, and the column ``removed_col`` (array of
    the removed lines' places among the lines with words; null where nothing was removed; None: no such
    column; underscores are added to a name that ``df`` has).

    Texts are joined with their removed lines by a sort-merge join at every size: the lines grow with the
    texts, so there is no size from which they'd be sent to every task.
    """
    places = repeated_lines(df, id_col, text_col, min_words).groupBy(*_DOC).agg(F.array_sort(F.collect_list("pos")).alias("gone"))
    doc, digest, gone = (free_name(c, df.columns) for c in ("gone_doc", "gone_digest", "gone"))
    places = stored(places.toDF(doc, digest, gone), "removed").hint("merge")
    joined = df.join(places, df[id_col].eqNullSafe(places[doc]) & (_digest(df[text_col]) == places[digest]), "left")
    out = [without(F.col(text_col), F.col(gone)).alias(c) if c == text_col else df[c] for c in df.columns]
    return joined.select(*out, *([F.col(gone).alias(free_name(removed_col, df.columns))] if removed_col else []))


def without(text: Column, gone: Column) -> Column:
    """``text`` without the worded lines at the places ``gone`` (sorted); the places of the lines with
    words come first, so that the removed ones are found by set operations, not line by line."""
    def cut(lines: Column) -> Column:
        worded = F.filter(F.transform(lines, lambda x, i: F.when(F.translate(x, SPACE_CHARS, "") != "", i)),
                          lambda i: i.isNotNull())
        drop = F.transform(F.array(worded), lambda w: F.transform(gone, lambda g: F.get(w, g)))[0]
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
        return F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(F.transform(F.array(F.split(text, "\n")), cut)[0])


SQL = f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
e AS (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) AS i FROM d),
w AS (SELECT doc_id, raw, i, regexp_extract_all(raw, '[^\\x20\\x09-\\x0D]+') AS ws FROM e),
l AS (SELECT doc_id, i, array_to_string(ws, ' ') AS line, len(ws) AS n,
             row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM w WHERE len(ws) > 0),
c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS upto FROM l),
a AS (SELECT doc_id, list(line ORDER BY pos) AS lines FROM l GROUP BY doc_id),
f AS (SELECT x.doc_id, x.pos AS s, y.pos AS t FROM c x ASOF JOIN c y ON x.doc_id = y.doc_id AND x.upto - x.n + {MIN_WORDS} <= y.upto),
b AS (SELECT x.doc_id, y.pos AS s, x.pos AS t FROM c x ASOF JOIN c y ON x.doc_id = y.doc_id AND x.upto - {MIN_WORDS} >= y.upto - y.n),
r AS (SELECT DISTINCT doc_id, s, t FROM (SELECT * FROM f UNION ALL SELECT * FROM b)),
k AS (SELECT r.*, md5(array_to_string(lines[s:t], chr(10))) AS what FROM r JOIN a USING (doc_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY what ORDER BY doc_id, s) AS nth FROM k),
g AS (SELECT DISTINCT doc_id, unnest(range(s, t + 1)) AS pos FROM o WHERE nth > 1),
z AS (SELECT e.doc_id, string_agg(e.raw, chr(10) ORDER BY e.i) FILTER (WHERE g.pos IS NULL) AS text, count(g.pos) AS n_removed
      FROM e LEFT JOIN l ON e.doc_id = l.doc_id AND e.i = l.i LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos
      GROUP BY e.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(z.text, '') END AS text, z.n_removed
FROM d JOIN z USING (doc_id)
"""
