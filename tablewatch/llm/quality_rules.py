"""Operator 9: quality rules with cross-document line frequency (DataFrame functions only).

Base counts come from each text alone. The method's own rule counts, for every normalised line, in
how many distinct documents of a host it stands. A line above the limit is boilerplate: it is
removed from all documents of the host but the first that has it, and a document that loses more
than a given share of its words is rejected. Documents with one and the same text count as one, so
exact copies alone never make a line boilerplate; that is left to de-duplication.

A line is normalised by lower-casing A to Z and joining its words by one space; lines without words
don't count. Null texts have no words. A null host is a host of its own. Equal ids with different
texts are judged each; repeated rows all get the same row. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import free_name, LOWER, SPACE_CHARS, UPPER, lower_ascii, stored, words

#: Words that a document has at least, and the percentage of them in repeated windows at most.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Distinct documents of a host that may have a line, and the share of words a document may lose.
MAX_LINE_DOCS, MAX_LOST = 100, 0.5
SYMBOLS = "#*$%&|<>"
WINDOW = 3


def _repeated_words(df: DataFrame) -> DataFrame:
    """Replace the word array ``w`` by ``n_words`` and ``n_repeat_words``.

    Each window of three words becomes a 64-bit hash. The hashes, sorted, show those that occur twice;
    only texts that have such look for their places, by membership while there are few and else by
    sorting (hash, place) pairs, so a text of any length costs n log n.
    """
    rest = [c for c in df.columns if c != "w"]
    hashes = F.when(F.size("w") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("w"), i + k) for k in range(WINDOW)])))
    df = df.select(*rest, F.size("w").cast("long").alias("n_words"), hashes.alias("h"))
    df = df.select(*rest, "n_words", "h", F.sort_array("h").alias("s"))
    twice = F.array_distinct(F.filter("s", lambda x, i: (i > 0) & (x == F.get(F.col("s"), i - 1))))
    df = df.select(*rest, "n_words", "h", twice.alias("twice"))
    few = F.filter(F.transform("h", lambda x, i: F.when(F.array_contains(F.col("twice"), x), i)),
                   lambda i: i.isNotNull())
    pairs = F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    same = F.transform(F.array(pairs), lambda p: F.filter(F.transform(
        p, lambda e, k: F.when((e["x"] == F.get(p, k - 1)["x"]) | (e["x"] == F.get(p, k + 1)["x"]), e["i"])),
        lambda i: i.isNotNull()))[0]
    places = F.when(F.coalesce(F.size("twice"), F.lit(0)) <= 0, F.array().cast("array<int>")).when(
        F.size("twice") <= 16, few).otherwise(F.sort_array(same))
    df = df.select(*rest, "n_words", places.alias("at"))
    covered = F.aggregate(F.transform("at", lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(
        F.least(F.lit(WINDOW), x - F.get(F.col("at"), k - 1)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(*rest, "n_words", covered.alias("n_repeat_words"))


def _lines(text: Column) -> Column:
    """Array of (normal, words) of the lines with a word, in their order."""
    return F.filter(F.transform(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n"), lambda x: F.transform(
        F.array(words(x)), lambda w: F.struct(F.array_join(w, " ").alias("normal"), F.size(w).alias("n")))[0]),
        lambda x: x["n"] > 0)


def base_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long), drop the text.

    Every other column is kept. The new names, and ``w h s twice at``, must be free.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = [c for c in df.columns if c != text_col]
    line = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    df = df.select(
        *rest, F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(line), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        words(text).alias("w"))
    return _repeated_words(df)


def _rows(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return df.select(df[id_col].alias("doc_id"), df[host_col].alias("host"), df[text_col].alias("text")).withColumn(
        "doc", _digest(F.col("text")))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _lost(rows: DataFrame, max_line_docs: int) -> DataFrame:
    """``doc_id, doc, n_words, n``: a row for each line that a document loses, with its words."""
    lines = rows.select("doc_id", "doc", "host", F.explode(_lines(F.col("text"))).alias("line")).select(
        "doc_id", "doc", "host", F.unhex(F.md5(F.col("line.normal").cast("binary"))).alias("line"),
        F.col("line.n").alias("n"))
    # a line's documents are first made distinct, which spreads a common line over all tasks
    common = lines.groupBy("host", "line", "doc").agg(F.min("doc_id").alias("first")).groupBy("host", "line").agg(
        F.count("*").alias("docs"), F.min("first").alias("first")).filter(F.col("docs") > max_line_docs)
    common = stored(common.select(F.col("host").alias("on_host"), F.col("line").alias("common"), "first"), "lines")
    return lines.join(common, lines["host"].eqNullSafe(common["on_host"]) & (lines["line"] == common["common"])
                      & ~lines["doc_id"].eqNullSafe(common["first"])).select("doc_id", "doc", "n")


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_line_docs: int = MAX_LINE_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept``."""
    rows = _rows(df, id_col, text_col, host_col)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    base = base_counts(rows.select("doc_id", "doc", "text"))
    both = base.select("doc_id", "doc", *names, F.lit(0).alias("n"), F.lit(1).alias("rows")).unionByName(
        _lost(rows, max_line_docs).withColumn("rows", F.lit(0)), allowMissingColumns=True)
    per = both.groupBy("doc_id", "doc").agg(
        *[F.max(c).alias(c) for c in names], F.sum("n").alias("lost"), F.sum("rows").alias("rows"))
    per = per.withColumn("lost_words", F.floor(F.col("lost") / F.col("rows")).cast("long"))
    return per.select(
        "doc_id", *names, "lost_words", _failed().alias("base_failed"),
        (~_failed() & (F.col("lost_words") <= max_lost * F.col("n_words"))).alias("kept"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row")).drop("row")


#: Rejected documents up to so many are sent to every task (under 10 MB); more are joined by a shuffle.
MAX_SENT = 100_000


def passing(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            max_line_docs: int = MAX_LINE_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """The rows of ``df``, all columns, that :func:`quality_rules` keeps.

    Base rules are decided where a row is read; only the ids of depleted documents are gathered.
    """
    own_id, own_doc = (free_name(c, df.columns) for c in ("depleted_id", "depleted_doc"))
    rows = _rows(df, id_col, text_col, host_col)
    lost = _lost(rows, max_line_docs).groupBy("doc_id", "doc").agg(F.sum("n").alias("lost"))
    size = rows.groupBy("doc_id", "doc").agg(F.count("*").alias("rows"), F.max(F.size(words(F.col("text")))).alias("n_words"))
    depleted = stored(size.join(lost.withColumnsRenamed({"doc_id": "_id", "doc": "_doc"}), F.col("doc_id").eqNullSafe(
        F.col("_id")) & (F.col("doc") == F.col("_doc"))).filter(
        F.floor(F.col("lost") / F.col("rows")) > max_lost * F.col("n_words")).select(F.col("_id").alias(own_id), F.col("_doc").alias(own_doc)), "depleted")
    if depleted.count() <= MAX_SENT:
        depleted = F.broadcast(depleted)
    judged = base_counts(df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[text_col].alias("text")))
    # a filter would be moved below the projections and work out the counts again for every word
    passed = judged.select(F.inline(F.filter(F.array("row"), lambda r: ~_failed())))
    return passed.join(depleted, F.col(id_col).eqNullSafe(F.col(own_id)) & (_digest(F.col(text_col)) == F.col(own_doc)), "left_anti")


SQL = f"""
WITH r AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS raw FROM r),
n AS (
  SELECT doc_id, host, t, raw, regexp_extract_all(translate(raw, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS lw
  FROM l),
k AS (SELECT doc_id, host, t, raw, array_to_string(lw, ' ') AS line, len(lw) AS nw FROM n WHERE len(lw) > 0),
c AS (
  SELECT host, line, min(doc_id) AS first FROM k GROUP BY host, line HAVING count(DISTINCT t) > {MAX_LINE_DOCS}),
lost AS (
  SELECT k.doc_id, sum(k.nw) AS lost FROM k JOIN c
  ON k.host IS NOT DISTINCT FROM c.host AND k.line = c.line AND k.doc_id <> c.first GROUP BY k.doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n_dup_lines FROM k GROUP BY doc_id),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM r),
x AS (SELECT doc_id, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM p
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, list(i) AS places FROM x WHERE w3 IS NOT NULL GROUP BY doc_id, word, w2, w3 HAVING count(*) > 1),
f AS (SELECT doc_id, unnest(places) AS i FROM g),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM f, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
b AS (
  SELECT r.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost, 0) AS BIGINT) AS lost_words
  FROM r LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND lost_words <= {MAX_LOST} * n_words AS kept
FROM b
"""
