"""Operator 12: hard negatives by lists that the anchors of a cluster share (MAXIMUS-style).

Rows are whole-number vectors (components times ``SCALE``, rounded down). For each anchor the best
rows of its own label are its positives; for each positive, the best rows of other labels whose score
lies within a window below the positive's are its hard negatives.

Anchors are the query set and are taken in blocks of at most ``BLOCK`` (a few MB). A block is clustered
by direction on the cluster and packed into one row; its centroids, and the widest angle of each, come
with it. A block is broadcast, and one job reads all rows beside it. Within a task, for each cluster of
anchors, the rows of a batch are sorted once by an upper bound of their score per unit of anchor length:
their length times the cosine of their angle to the centroid less the cluster's widest angle. Every
member walks that list in strides and stops when its worst wanted score is above the bound of all that
follows, so results are exact. What a task knows already shortens the walks of its later batches. Tasks
give few rows per anchor, which are ranked together. The clustering changes speed only.

No vector is shuffled, but for the hundredth part that are anchors; work grows with anchors times rows
in the worst case, as any exact search.

Rows with a null id, label or vector, or a null, NaN or infinite component take no part. Vectors of
unequal length score over the components both have. "Other rows" are rows of another id; repeated rows
each take a place of their own, repeated anchors give their rows once. Ties go to the smaller id.
Anchors without positives, or positives without negatives, give no rows. Scores beyond 64 bits are an
error. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewatch.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is within these hundredths of its positive's.
WINDOW = (30, 90)
#: Anchors of a block and bytes of its vectors, about; anchors of a cluster on average.
BLOCK, BLOCK_BYTES, MEMBERS = 8192, 8 << 20, 64
#: Rows of a step of the walk, and of a list.
STRIDE, LIST = 512, 16384
#: Whole numbers up to this are exact in a double.
EXACT = 1 << 53


def vectors(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
            label: Column | None = None) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    x = F.col("vector")
    rows = df.select(df[id_col].cast("long").alias("vec_id"), (df[label_col] if label is None else label).cast("long").alias("label"),
                     df[vector_col].cast("array<double>").alias("vector"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))


def matrix(column):
    """Scaled components of an Arrow list column as whole numbers in doubles, short rows filled with 0."""
    import numpy as np

    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.offsets)
    n = np.diff(ends)
    if len(n) and (n == n[0]).all():
        return np.floor(flat * float(SCALE)).reshape(len(n), int(n[0]))
    out = np.zeros((len(n), int(n.max(initial=0))))
    for i in range(len(n)):
        out[i, :n[i]] = np.floor(flat[ends[i] - ends[0]:ends[i + 1] - ends[0]] * float(SCALE))
    return out


def scores(a, b):
    """Exact inner products of the rows of ``a`` with the rows of ``b``, as whole numbers."""
    import numpy as np

    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    most = (np.abs(a).sum(axis=1).max(initial=0)) * np.abs(b).max(initial=0)
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    a, b = (np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (a, b))
    return np.dot(a, b.T).astype(np.int64)  # beyond 64 bits: OverflowError


def clusters(anchors, rounds: int = 4):
    """Cluster of every anchor, by direction; unit centroids; widest angle of each cluster."""
    import numpy as np

    length = np.linalg.norm(anchors, axis=1, keepdims=True)
    unit = anchors / np.where(length > 0, length, 1)
    k = max(1, len(unit) // MEMBERS)
    centres = unit[np.linspace(0, len(unit) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        of = (unit @ centres.T).argmax(axis=1)
        for c in range(k):
            mean = unit[of == c].sum(axis=0)
            if (norm := np.linalg.norm(mean)) > 0:
                centres[c] = mean / norm
    of = (unit @ centres.T).argmax(axis=1)
    near = np.clip((unit * centres[of]).sum(axis=1), -1, 1)
    angles = np.arccos(near)
    angles[length[:, 0] == 0] = 0  # their scores are 0 whatever the angle
    return of, centres, np.array([angles[of == c].max(initial=0) for c in range(k)])


def blocks(anchors: DataFrame) -> DataFrame:
    """``block, packed``: the anchors of each block with their clusters, as one NumPy archive."""
    def pack(key, table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        column = table.column("vector")
        v = matrix(column.chunk(0) if column.num_chunks else column.combine_chunks())
        of, centres, widest = clusters(v)
        out = io.BytesIO()
        np.savez(out, id=table.column("vec_id").to_numpy(), label=table.column("label").to_numpy(),
                 vector=v, of=of, centres=centres, widest=widest)
        return pa.table({"block": [key[0].as_py()], "packed": [out.getvalue()]}, pa.schema([("block", pa.int64()), ("packed", pa.binary())]))

    return anchors.groupBy("block").applyInArrow(pack, "block long, packed binary")


class Block:
    def __init__(self, packed: bytes):
        import numpy as np

        found = np.load(io.BytesIO(packed))
        self.id, self.label, self.vector = found["id"], found["label"], found["vector"]
        self.of, self.centres, self.widest = found["of"], found["centres"], found["widest"]
        self.length = np.linalg.norm(self.vector, axis=1)
        self.members = [np.flatnonzero(self.of == c) for c in range(len(self.widest))]


class Best:
    """The ``k`` best (score, id) of each of ``n`` queries, kept over many offers."""

    def __init__(self, n: int, k: int):
        import numpy as np

        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.full = np.zeros(n, np.int64)

    def worst(self, which):
        """Score of the last place; the least number where places are free."""
        return self.score[which, self.k - 1]

    def offer(self, which, score, ids, mask) -> None:
        """``score[i, j]`` of row ``ids[j]`` for query ``which[i]``, where the mask holds."""
        import numpy as np

        mask = mask & (score >= self.worst(which)[:, None])
        for i in np.flatnonzero(mask.any(axis=1)):
            at, q = np.flatnonzero(mask[i]), which[i]
            own = score[i, at]
            if len(at) > 4 * self.k:  # what can't be among the best goes first
                keep = own >= np.partition(own, len(own) - self.k)[len(own) - self.k]
                at, own = at[keep], own[keep]
            n = min(self.k, self.full[q])
            all_scores = np.concatenate([self.score[q, :n], own])
            all_ids = np.concatenate([self.id[q, :n], ids[at]])
            order = np.lexsort((all_ids, -all_scores))[:self.k]
            self.full[q] = len(order)
            self.score[q, :len(order)], self.id[q, :len(order)] = all_scores[order], all_ids[order]


def walk(block: Block, ids, labels, v, offer) -> None:
    """Each cluster's list over the rows, walked by its members.

    ``offer(members, score, ids, labels, bound)`` takes the scores of a stride and returns which of the
    members go on, given the most that any row behind can score for them.
    """
    import numpy as np

    length = np.linalg.norm(v, axis=1)
    d = min(v.shape[1], block.vector.shape[1])
    # over the components that both have, a row's length and an anchor's bound their score as well
    unit = np.divide(v, length[:, None], out=np.zeros_like(v), where=length[:, None] > 0)[:, :d]
    shared = v.shape[1] == block.vector.shape[1]
    for c, members in enumerate(block.members):
        if not len(members):
            continue
        cosine = np.clip(unit @ block.centres[c, :d], -1, 1)
        bound = length * (np.cos(np.maximum(0, np.arccos(cosine) - block.widest[c])) if shared else 1)
        order = np.argsort(-bound)
        bound = bound[order]
        for at in range(0, len(order), STRIDE):
            part = order[at:at + STRIDE]
            behind = bound[at + STRIDE] if at + STRIDE < len(order) else -np.inf
            most = behind * block.length[members] if behind > -np.inf else np.full(len(members), -np.inf)
            # room for rounding: the bound only ends walks
            most = np.where(most > -np.inf, most + np.abs(block.length[members]) * length.max(initial=0) * 1e-6 + 1e-6, most)
            members = members[offer(members, scores(block.vector[members], v[part]), ids[part], labels[part], most)]
            if not len(members):
                break


def _lists(batches: Iterator) -> Iterator:
    """``ids, labels, matrix`` of the rows, at most ``LIST`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, LIST):
            part = batch.slice(at, LIST)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2))


def positives(rows: DataFrame, packed, k: int = POSITIVES) -> DataFrame:
    """``anchor, vec_id, score``: of each task, the best rows of the anchor's label. ``anchor`` is its place in the block."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        block = Block(packed.value)
        best = Best(len(block.id), k)

        def offer(members, score, ids, labels, most):
            mask = (labels[None, :] == block.label[members][:, None]) & (ids[None, :] != block.id[members][:, None])
            best.offer(members, score, ids, mask)
            return best.worst(members) <= most  # a row behind can tie and have a smaller id

        for ids, labels, v in _lists(batches):
            walk(block, ids, labels, v, offer)
        at = np.arange(best.k)[None, :] < best.full[:, None]
        anchor = np.broadcast_to(np.arange(len(block.id))[:, None], at.shape)[at]
        yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(best.id[at]), pa.array(best.score[at])],
                                         names=["anchor", "vec_id", "score"])

    return rows.mapInArrow(run, "anchor int, vec_id long, score long")


def negatives(rows: DataFrame, packed, wanted, k: int = NEGATIVES, window: tuple[int, int] = WINDOW) -> DataFrame:
    """``anchor, place, vec_id, score``: of each task, the best rows of other labels within the window of
    each positive. ``wanted`` holds, by place, anchors and their positives' scores."""
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        block = Block(packed.value)
        places = []
        for anchors, values in wanted.value:
            score = np.zeros(len(block.id), np.int64)
            score[anchors] = values
            has = np.zeros(len(block.id), bool)
            has[anchors] = True
            # whole-number limits of the window: Python's // rounds down
            low = np.array([-(-window[0] * int(s) // 100) for s in score], np.int64)
            high = np.array([window[1] * int(s) // 100 for s in score], np.int64)
            places.append((has & (low <= high), low, high, Best(len(block.id), k)))

        def offer(members, score, ids, labels, most):
            other = (labels[None, :] != block.label[members][:, None]) & (ids[None, :] != block.id[members][:, None])
            on = np.zeros(len(members), bool)
            for has, low, high, best in places:
                go = has[members]
                if go.any():
                    which = members[go]
                    s = score[go]
                    best.offer(which, s, ids, other[go] & (s >= low[which][:, None]) & (s <= high[which][:, None]))
                    on[go] |= (best.worst(which) <= most[go]) & (low[which] <= most[go])
            return on

        for ids, labels, v in _lists(batches):
            walk(block, ids, labels, v, offer)
        for place, (_, _, _, best) in enumerate(places):
            at = np.arange(best.k)[None, :] < best.full[:, None]
            anchor = np.broadcast_to(np.arange(len(block.id))[:, None], at.shape)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int32)), pa.array(np.full(len(anchor), place, np.int32)), pa.array(best.id[at]),
                 pa.array(best.score[at])], names=["anchor", "place", "vec_id", "score"])

    return rows.mapInArrow(run, "anchor int, place int, vec_id long, score long")


def _ranked(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key; a key has at most k rows of every task."""
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, block_size: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for all rows of ``vectors``."""
    import numpy as np

    spark = rows.sparkSession
    anchors = stored(rows.filter(is_anchor).dropDuplicates(), "anchors")
    n, width = anchors.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    n_blocks = -(-n // max(1, min(block_size, BLOCK_BYTES // (8 * max(1, width)))))
    # a hash deals about equal blocks
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(max(1, n_blocks)).cast("long")))
    packed = stored(blocks(dealt), "blocks")
    out = []
    for b in range(n_blocks):
        found = packed.filter(F.col("block") == b).first()
        if not found:
            continue
        block = Block(bytes(found["packed"]))
        shared = spark.sparkContext.broadcast(bytes(found["packed"]))
        best = stored(_ranked(positives(rows, shared), ["anchor"], POSITIVES), "positives")
        got = best.select("anchor", "rank", "score").toPandas()  # five numbers for each anchor of the block
        wanted = spark.sparkContext.broadcast([
            (p["anchor"].to_numpy(np.int64), p["score"].to_numpy(np.int64)) for _, p in sorted(got.groupby("rank"))])
        near = _ranked(negatives(rows, shared, wanted), ["anchor", "place"], NEGATIVES)
        own = best.select("anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        ids = spark.createDataFrame([(i, int(v)) for i, v in enumerate(block.id)], "anchor int, anchor_id long")
        out.append(stored(near.join(own, ["anchor", "place"]).join(ids, "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")), "negatives"))
        shared.unpersist()
        wanted.unpersist()
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
       AND {WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW[1]} * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= {NEGATIVES}
"""
