"""Hard negatives against brute force, with ties, odd rows and several blocks."""
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import hard_negatives as H

COLUMNS = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"


def brute(rows):
    fine = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows
            if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, y, v in {(i, y, tuple(v)) for i, y, v in fine if i % 100 == 0}:
        seen = sorted((-dot(v, w), i, z) for i, z, w in fine if i != a)
        for ps, p in [(-s, i) for s, i, z in seen if z == y][:5]:
            near = [(-s, i) for s, i, z in seen if z != y and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(a, p, k + 1, n, ps, ns) for k, (ns, n) in enumerate(near)]
    return Counter(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("vector", F.lit("x"))
    out = H.hard_negatives(H.vectors(df), F.col("vec_id") % 100 == 0, **more)
    assert out.columns == list(COLUMNS)
    return Counter(map(tuple, out.collect()))


def test_against_brute_force(spark):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(4)]
    rows = [(i, i % 4, [x + rng.gauss(0, 0.7) for x in centres[i % 4 if i % 3 else 0]]) for i in range(3000)]
    want = brute(rows)
    assert len(want) > 500 and run(spark, rows) == want
    assert run(spark, rows, block_size=7) == want  # several blocks


def test_ties_nulls_and_repeats(spark):
    rng = random.Random(9)
    rows = [(i, i % 3, [0.5, 0.25, float(rng.randint(0, 2)) / 4]) for i in range(600)]
    rows += [(7, 1, [0.5, 0.25, 0.0])] * 3 + [(100, 1, [0.5, 0.25, 0.25])] * 2 + [(200, 0, [1.0, 1.0, 1.0])]
    rows += [(None, 1, [1.0] * 3), (700, None, [1.0] * 3), (701, 1, None), (800, 1, [1.0, None, 1.0]), (801, 1, [math.nan, 1.0, 1.0]),
             (802, 2, [math.inf, 0.0, 0.0]), (900, 1, [0.0, 0.0, 0.0]), (1000, 2, []), (1001, 2, [2.0]), (1100, 0, [1.0, 1.0, 1.0, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert not run(spark, [(None, None, None)]) and not run(spark, [(0, 1, [1.0])]) and run(spark, [(5, 1, [1.0])]) == {}


def test_scores_are_exact_or_refused():
    a = np.array([[2.0 ** 40, 3.0, -5.0]])
    assert H.scores(a, np.array([[2.0 ** 20, 1.0, 1.0]])).tolist() == [[2 ** 60 - 2]]
    with pytest.raises(OverflowError):
        H.scores(a, a * 2.0 ** 20)


def test_walks_end_early():
    rng = np.random.default_rng(3)
    v = np.floor(rng.normal(size=(20_000, 8)) * 40 * rng.lognormal(0, 1, size=(20_000, 1)))
    block = H.Block.__new__(H.Block)
    block.vector, block.id = v[:200], np.arange(200)
    block.label = np.zeros(200, np.int64)
    block.of, block.centres, block.widest = H.clusters(block.vector)
    block.length = np.linalg.norm(block.vector, axis=1)
    block.members = [np.flatnonzero(block.of == c) for c in range(len(block.widest))]
    best, seen = H.Best(200, 5), 0

    def offer(members, score, ids, labels, most):
        nonlocal seen
        seen += score.size
        best.offer(members, score, ids, ids[None, :] != members[:, None])
        return best.worst(members) <= most

    H.walk(block, np.arange(20_000), np.zeros(20_000, np.int64), v, offer)
    whole = H.scores(block.vector, v)
    whole[np.arange(200), np.arange(200)] = np.iinfo(np.int64).min
    want = np.sort(whole, axis=1)[:, :-6:-1]
    assert (best.score == want).all() and seen < 0.5 * whole.size
