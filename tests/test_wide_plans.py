"""Correlations of wide tables, binned densities, indexed categories and samples of many checks."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.compat import EDA
from tablewatch.operators import features as FE
from tablewatch.plans import checks as K
from tablewatch.plans import distribution as D


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_correlation_is_pairwise_complete_and_one_scan(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 20)) @ rng.normal(size=(20, 20)) + 1e7
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 5.0
    x[:, 8] = np.nan
    x[1:, 9] = np.nan
    rows = [tuple(None if i % 2 and math.isnan(v) else float(v) for v in r) for i, r in enumerate(x)]
    spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(20))).repartition(7).write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    out = D.correlation_matrix(df)
    assert plan(out).count("Scan parquet") == 1
    got = {(r["column_x"], r["column_y"]): r["correlation"] for r in out.collect()}
    assert len(got) == 400
    for i in range(20):
        for j in range(20):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            r = got[f"c{i}", f"c{j}"]
            if both.sum() < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
                assert r is None
            else:
                assert r == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)
    assert len(D.correlation_matrix(df.limit(0)).collect()) == 400


def test_binned_density_is_close_to_the_exact_one(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.gauss(0, 1) if rng.random() < 0.7 else rng.gauss(6, 0.3), 1.0, None, float(i)) for i in range(5000)],
                               "x double, flat double, none double, y double")
    exact, binned = ({(r["column"], r["point"]): r for r in D.density_curve(df, points=40, bins=b).collect()} for b in (None, D.DENSITY_BINS))
    assert exact.keys() == binned.keys()
    for k, r in exact.items():
        top = max(q["density"] or 0 for (c, _), q in exact.items() if c == k[0])
        if r["density"] is None:
            assert binned[k]["density"] is None and binned[k]["x"] == r["x"]
        else:
            assert abs(binned[k]["density"] - r["density"]) <= 1e-5 * top and binned[k]["x"] == pytest.approx(r["x"])
    with pytest.raises(ValueError):
        D.density_curve(df, bins=1)


def test_indexed_categories(spark, sf_small):
    rng = random.Random(5)
    rows = [(i, rng.choice(["b", "a", None, "Z", "", "é"]), rng.choice([3, 20, None]), "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, c string, n int, c_index string")
    out = FE.one_hot_indexed(df, ["c", "n"])
    assert out.columns == ["id", "c", "n", "c_index", "c_index_2", "n_index"]
    order = {v: i for i, v in enumerate([None, "", "Z", "a", "b", "é"])}
    numbers = {v: i for i, v in enumerate([None, 20, 3])}  # as text
    assert sorted((r["id"], r["c_index_2"], r["n_index"]) for r in out.collect()) == [(i, order[c], numbers[n]) for i, c, n, _ in rows]
    assert FE.one_hot_indexed(df.limit(0), ["c"]).count() == 0
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    made = EDA(docs).feature_engineering(max_categories=30)
    assert "text_index" in made.columns and "lang_index" not in made.columns and made.count() == docs.count()
    with pytest.raises(ValueError, match="too many"):
        FE.one_hot(docs, ["text"], max_categories=30)


def test_rows_are_not_moved_by_a_few_categories(spark, monkeypatch):
    rows = [(i, [None, "", "a", "é"][i % 4], f"{i % 700} long text " * 20 if i % 9 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, c string, t string").repartition(4)
    order = {"c": [None, "", "a", "é"], "t": sorted({t for _, _, t in rows}, key=lambda t: (t is not None, t or ""))}
    wanted = [(i, order["c"].index(c), order["t"].index(t)) for i, c, t in rows]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = FE.one_hot_indexed(df, ["c", "t"]).select("id", "c_index", "t_index")
        assert sorted(map(tuple, small.collect())) == wanted
        assert "SortMergeJoin" not in plan(small)
        monkeypatch.setattr(FE, "BROADCAST_BYTES", 1000)
        by_digest = FE.one_hot_indexed(df, ["c", "t"]).select("id", "c_index", "t_index")
        assert sorted(map(tuple, by_digest.collect())) == wanted
        assert plan(by_digest).split("== Initial Plan ==")[0].count("SortMergeJoin") == 1  # the long texts alone
        assert FE.one_hot_indexed(df, ["c", "t"]).columns == ["id", "c", "t", "c_index", "t_index"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_failing_rows_of_all_checks(spark, tmp_path):
    rows = [(i, i % 50, "x" if i % 7 else None) for i in range(2000)] + [(5, 5, "again"), (5, 6, None)]
    spark.createDataFrame(rows, "id int, v int, t string").repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = [K.value_range(df, "v", 5, 45), K.completeness(df, ["t"]), K.uniqueness(df, "id"), K.value_range(df, "id", 0, 5000)]
    predicates = K.failing_sample(df, checks[:2], 8)
    assert plan(predicates).count("Scan parquet") == 1 and "WindowGroupLimit" in plan(predicates)
    out = K.failing_rows_all(df, checks, 8).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["place"]):
        got.setdefault((r["check"], r["column"]), []).append(tuple(r["row"]))
    assert len(got["value_range", "v"]) == 8 and all(v < 5 or v > 45 for _, v, _ in got["value_range", "v"])
    assert sorted(got["uniqueness", "id"], key=str) == sorted([(5, 5, "x"), (5, 5, "again"), (5, 6, None)], key=str)
    assert ("value_range", "id") not in got and len(got["completeness", "t"]) == 8
    again = K.failing_rows_all(df.repartition(3), checks, 8).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    first = K.failing_rows_all(df, checks[:1], 3, order_by=["id", F.col("v")]).collect()
    assert [r["row"]["id"] for r in sorted(first, key=lambda r: r["place"])] == [0, 1, 2]
    with pytest.raises(ValueError):
        K.failing_rows_all(df, [])
