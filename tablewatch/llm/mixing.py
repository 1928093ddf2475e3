"""Operator 11: mixing overlapping sources to target weights, by min-cost flow.

A document belongs to one or more sources (its membership). Documents of one membership are alike
to the mix, so they are aggregated to one pattern with their words as capacity. A flow routes words
of patterns to the quotas of their sources. Taking a pattern's words once costs less than twice, and
that less than a third time (convex repetition costs), so words are repeated only where first use
can't fill the quotas. As costs lie on the arcs into patterns only, the cheapest flow is found pass by
pass: each pass adds every pattern's capacity once more and augments the flow to its maximum.

Within a pattern, documents stand in a seeded order (a digest of seed and id). What the flow takes
from a pattern is so many whole rounds of it and a remainder; the remainder takes the documents that
come first, the last of them in part, so quotas are met to the word. The place where the remainder
ends is found by radix selection on the digests: sums by 12-bit digit, one aggregation a digit for all
patterns, until few documents are left. No pattern's documents are sorted or gathered.

Sources and patterns reach the driver, never documents: at most ``MAX_PATTERNS`` of them, counted
first, and more are refused.

Null or empty texts have size 0 and nothing is taken of them. A null source is a source of its own,
last in the order. A null or empty membership belongs to no source; nothing is taken. Rows equal in id
and size share what is taken of them evenly, rounded down, so a rerun gives the same rows. An empty
table gives none. Other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import n_words, stored

WEIGHTS, SEED = (5, 2, 1), 42
#: Times a document is used at most.
MAX_USES = 3
MAX_PATTERNS = 100_000
#: Bits of the digest that orders documents, of a digit, and documents left when selection ends.
KEY_BITS, DIGIT_BITS, FEW = 60, 12, 4096


def targets(total: int, sizes: Sequence[int], weights: Sequence[int], max_uses: int = MAX_USES) -> list[float]:
    """Shares of ``total`` by weight; a share stops at ``max_uses`` times its size, and the excess is
    shared among the others by weight until none is above."""
    rest, open_weight = total, sum(weights)
    out = [float(max_uses * s) for s in sizes]
    for i in sorted(range(len(sizes)), key=lambda i: (max_uses * sizes[i] / weights[i], i)):
        share = rest / open_weight * weights[i]
        if share > max_uses * sizes[i]:
            rest, open_weight = rest - max_uses * sizes[i], open_weight - weights[i]
        else:
            out[i] = share
    return out


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], max_uses: int = MAX_USES) -> list[dict[int, int]]:
    """Words from each pattern ``(sources, words)`` to each source: the largest flow within the quotas,
    of the least repetition. Each pass offers every pattern once more and augments along shortest paths."""
    flow: list[dict[int, int]] = [{} for _ in patterns]
    users: list[set[int]] = [set() for _ in quotas]  # patterns that a source has words of
    left = list(quotas)
    for _ in range(max_uses):
        spare = [words for _, words in patterns]
        # most patterns are served straight away; only what is left needs longer paths
        for p, (sources, _) in enumerate(patterns):
            for s in sources:
                _move(flow, users, spare, left, [(p, s)], p, s)
        for p in range(len(patterns)):
            while spare[p] and (path := _path(patterns, flow, users, left, p)):
                _move(flow, users, spare, left, path, p, path[-1][1])
    return flow


def _path(patterns, flow, users, left, start: int) -> list[tuple[int, int]] | None:
    """Steps (pattern, source) of a shortest path from a pattern to a source with room: a full source
    gives back words of another pattern, which goes on to another of its sources."""
    came: dict[int, tuple[int, int]] = {}
    by = {start: -1}
    queue = deque([start])
    while queue:
        p = queue.popleft()
        for s in patterns[p][0]:
            if s in came:
                continue
            came[s] = (p, by[p])
            if left[s]:
                path, at = [], s
                while at >= 0:
                    path.append((came[at][0], at))
                    at = came[at][1]
                return path[::-1]
            for q in sorted(users[s]):
                if q not in by:
                    by[q] = s
                    queue.append(q)
    return None


def _move(flow, users, spare, left, path, start: int, end: int) -> None:
    backs = [(path[i + 1][0], path[i][1]) for i in range(len(path) - 1)]  # who gives up which source's words
    amount = min([spare[start], left[end], *(flow[q][s] for q, s in backs)])
    if not amount:
        return
    spare[start] -= amount
    left[end] -= amount
    for p, s in path:
        flow[p][s] = flow[p].get(s, 0) + amount
        users[s].add(p)
    for q, s in backs:
        flow[q][s] -= amount
        if not flow[q][s]:
            users[s].discard(q)
            del flow[q][s]


def _key(doc_id: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def sized(df: DataFrame, id_col: str, size: Column, membership: Column, seed: int) -> DataFrame:
    """``doc_id, size, sources, key`` of every row; ``sources`` sorted and without repeats."""
    return df.select(df[id_col].alias("doc_id"), size.cast("long").alias("size"),
                     F.array_sort(F.array_distinct(membership.cast("array<string>"))).alias("sources"),
                     _key(df[id_col], seed).alias("key"))


def patterns_of(docs: DataFrame) -> list[tuple[list, int]]:
    """``(sources, words)`` of every pattern, in a fixed order. They are counted before they are collected."""
    by = docs.filter("size(sources) > 0").groupBy("sources").agg(F.sum("size").alias("words"))
    by = stored(by, "patterns")
    if by.count() > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} different memberships; mix fewer or coarser sources")
    return sorted(((list(r["sources"]), r["words"]) for r in by.collect()),
                  key=lambda x: [(s is None, s or "") for s in x[0]])


def _ends(docs: DataFrame, wanted: list[tuple[int, int]]) -> dict[int, tuple]:
    """Where the remainder of a pattern ends: pattern -> (key, id, size, words of each such row)."""
    spark, schema = docs.sparkSession, "pattern int, prefix long, need long"
    state = [(p, 0, need) for p, need in wanted]
    bits = 0
    while state:
        at = F.broadcast(spark.createDataFrame(state, schema))
        near = docs.join(at, "pattern").filter(F.shiftright("key", KEY_BITS - bits) == F.col("prefix"))
        if bits + DIGIT_BITS > KEY_BITS:
            break
        if bits and near.groupBy("pattern").count().agg(F.max("count")).first()[0] <= FEW:
            break
        bits += DIGIT_BITS
        digits = near.groupBy("pattern", "need", F.shiftright("key", KEY_BITS - bits).alias("digit")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(W.partitionBy("pattern").orderBy("digit"))  # 4096 digits a pattern at most
        found = digits.withColumn("upto", upto).filter("upto >= need and upto - words < need")
        state = [(r["pattern"], r["digit"], r["need"] - (r["upto"] - r["words"])) for r in found.collect()]
    if not state:
        return {}
    alike = near.groupBy("pattern", "need", "key", "doc_id", "size").agg(F.count("*").alias("n"))
    order = W.partitionBy("pattern").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    last = (alike.withColumn("words", F.col("size") * F.col("n")).withColumn("upto", F.sum("words").over(
        order.rowsBetween(W.unboundedPreceding, 0))).filter("upto >= need and upto - words < need"))
    return {r["pattern"]: (r["key"], r["doc_id"], r["size"], (r["need"] - (r["upto"] - r["words"])) // r["n"]) for r in last.collect()}


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", membership: Column | None = None,
        weights: Sequence[int] = WEIGHTS, max_uses: int = MAX_USES, seed: int = SEED, size: Column | None = None) -> DataFrame:
    """``doc_id, size, sources, taken, source_sizes, source_targets`` of every row.

    ``membership`` is an array of the row's sources (default: the column ``source``); ``weights`` repeat
    over the sources by code point. The two maps by source are arrays in the order of ``sources``.
    """
    spark = df.sparkSession
    membership = F.array(df["source"]) if membership is None else membership
    size = n_words(df[text_col]) if size is None else size
    docs = stored(sized(df, id_col, size, membership, seed), "sized")
    patterns = patterns_of(docs)
    names = sorted({s for sources, _ in patterns for s in sources}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    inner = [([place[s] for s in sources], words) for sources, words in patterns]
    sizes = [0] * len(names)
    for sources, words in inner:
        for s in sources:
            sizes[s] += words
    goals = targets(sum(w for _, w in inner), sizes, [weights[i % len(weights)] for i in range(len(names))], max_uses)
    flows = route(inner, [int(g + 0.5) for g in goals], max_uses)
    rows = []
    for i, ((sources, words), (own, _), flow) in enumerate(zip(patterns, inner, flows, strict=True)):
        total = sum(flow.values())
        rows.append((i, sources, total // words if words else 0, total % words if words else 0,
                     [sizes[s] for s in own], [goals[s] for s in own]))
    plan = F.broadcast(spark.createDataFrame(
        rows, "pattern int, of array<string>, rounds long, need long, source_sizes array<long>, source_targets array<double>"))
    docs = docs.join(plan, F.col("sources").eqNullSafe(F.col("of")), "left").drop("of")
    ends = _ends(docs.select("pattern", "key", "doc_id", "size").filter("size > 0"), [(r[0], r[3]) for r in rows if r[3]])
    id_type = docs.schema["doc_id"].dataType
    end_rows = [(p, (key, doc_id, words), part) for p, (key, doc_id, words, part) in ends.items()]
    end_type = T.StructType([T.StructField("ended", T.IntegerType()), T.StructField("last", T.StructType([
        T.StructField("key", T.LongType()), T.StructField("doc_id", id_type), T.StructField("size", T.LongType())])),
        T.StructField("part", T.LongType())])
    end = F.broadcast(spark.createDataFrame(end_rows, end_type))
    here = F.struct("key", "doc_id", "size")
    extra = F.when(F.col("last").isNull(), 0).when(here.eqNullSafe(F.col("last")), F.col("part")).when(
        here < F.col("last"), F.col("size")).otherwise(0)
    docs = docs.join(end, F.col("pattern") == F.col("ended"), "left")
    taken = F.coalesce(F.col("rounds") * F.col("size") + extra, F.lit(0)).cast("long")
    return docs.select("doc_id", "size", "sources", taken.alias("taken"), "source_sizes", "source_targets")


#: The query's rows; the same seeded order.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{SEED}-' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {KEY_BITS // 4}) AS BIGINT) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, CAST({MAX_USES} * sum(size) AS BIGINT) AS cap,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w
      FROM d GROUP BY source),
o AS (SELECT *, CAST(sum(n) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
                / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
      FROM s WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min_by(level, cap / w) FILTER (level * w <= cap) AS level FROM o),
t AS (SELECT source, n, CASE WHEN o.level * w > cap THEN CAST(cap AS DOUBLE) ELSE f.level * w END AS target FROM o, f),
p AS (SELECT doc_id, d.source, size, n, target, CAST(floor(target + 0.5) AS BIGINT) AS quota,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       CASE WHEN n = 0 THEN 0 ELSE quota // n * size + greatest(0, least(size, quota % n - before)) END AS taken
FROM p
"""
