"""Mixing against minimum cuts, brute-force selection and its contract."""
import hashlib
import itertools
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tablewatch.llm import mixing


def most(patterns, quotas, uses):
    """Largest flow, as the smallest cut over all sets of sources."""
    best = None
    for k in range(len(quotas) + 1):
        for full in itertools.combinations(range(len(quotas)), k):
            cut = sum(quotas[s] for s in full) + uses * sum(w for own, w in patterns if set(own) - set(full))
            best = cut if best is None else min(best, cut)
    return best


def test_flow_is_largest_and_repeats_least():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 5)
        patterns = [(rng.sample(range(n), rng.randint(1, n)), rng.randint(0, 20)) for _ in range(rng.randint(1, 7))]
        quotas = [rng.randint(0, 50) for _ in range(n)]
        flow = mixing.route(patterns, quotas, 3)
        for (own, words), f in zip(patterns, flow, strict=True):
            assert set(f) <= set(own) and 0 <= sum(f.values()) <= 3 * words
        for s in range(n):
            assert sum(f.get(s, 0) for f in flow) <= quotas[s]
        for uses in (1, 2, 3):  # the cheapest flow has the most words in each first use
            got = sum(min(sum(f.values()), uses * words) for (_, words), f in zip(patterns, flow, strict=True))
            assert got == most(patterns, quotas, uses)


def test_targets_stop_at_three_times_the_size():
    got = mixing.targets(100, [1, 9, 90], [5, 2, 1])
    assert got[:2] == [3.0, 27.0] and abs(sum(got) - 100) < 1e-9
    assert mixing.targets(0, [0, 0], [5, 2]) == [0.0, 0.0]


def brute(rows):
    """``(doc_id, size, source_size, target, taken)`` of rows (doc_id, size, source)."""
    by = defaultdict(list)
    for doc_id, size, source in rows:
        by[source].append((doc_id, size))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for _, n in by[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(sizes.values())
    while free:
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if shares[s] > 3 * sizes[s]}
        target |= {s: float(3 * sizes[s]) for s in over} if over else shares
        rest -= sum(target[s] for s in over)
        free = free - over if over else set()
    out = []
    for s in names:
        quota, at = int(target[s] + 0.5), 0
        key = lambda r: (int(hashlib.md5(f"42-{'' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16), r[0] or 0, r[1])
        for doc_id, size in sorted(by[s], key=key):
            taken = quota // sizes[s] * size + max(0, min(size, quota % sizes[s] - at)) if sizes[s] else 0
            at += size
            out.append((doc_id, size, sizes[s], round(target[s], 6), taken))
    return out


def test_mix_of_single_sources(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([0, 1, 3, 40, 500]), rng.choice(["a", "b", "c", "Ä", None, "z"]) if i % 3 else "hot") for i in range(6000)]
    rows.append((None, 7, "b"))
    df = spark.createDataFrame([(i, " ".join(["w"] * n) if n or i % 2 else None, s, 1, 2) for i, n, s in rows],
                               "doc_id long, text string, source string, size int, key int")
    got = [(r["doc_id"], r["size"], r["source_sizes"][0], round(r["source_targets"][0], 6), r["taken"]) for r in mixing.mix(df).collect()]
    assert Counter(got) == Counter(brute(rows))
    assert Counter(map(tuple, mixing.mix(df.repartition(5)).select("doc_id", "taken").collect())) == Counter((r[0], r[4]) for r in got)


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "x y z " * 5, ["a", "b"] if i % 2 else ["b"]) for i in range(400)] + [(1000, "x", None), (1001, "x", []), (1002, None, ["c", "a", "a"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, own array<string>")
    out = mixing.mix(df, membership=F.col("own")).collect()
    assert len(out) == 403 and all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    assert sum(r["taken"] for r in out) == 6000  # all quotas can be met: 5/8 of a at three uses, the rest of b
    assert {r["taken"] for r in out if r["doc_id"] >= 1000} == {0}


def test_mix_of_repeated_rows_and_empty_tables(spark):
    same = spark.createDataFrame([(1, "a b c", "s"), (2, "d", "t")] + [(1, "a b c", "s")] * 4999, "doc_id long, text string, source string")
    out = mixing.mix(same)
    taken = Counter(r["taken"] for r in out.filter("doc_id = 1").collect())
    assert len(taken) == 1 and out.count() == 5001  # copies that can't be told apart get the same
    assert mixing.mix(same.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(empty).collect()] == [0, 0]
