import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewatch.plans import distribution as D
from tablewatch.plans import profile as PR
from tablewatch.plans.quantiles import exact_quantiles


def test_null_counts_and_row_count(dq):
    nc = {r.column: r.null_count for r in PR.null_counts(dq).collect()}
    assert nc == {"id": 0, "name": 1, "age": 2, "join_date": 1, "salary": 1, "category": 1, "score": 1}
    nan = {r.column: r.null_count for r in PR.null_counts(dq, ["score"], nan_as_null=True).collect()}
    assert nan == {"score": 2}
    assert tuple(PR.row_count(dq).collect()[0]) == (8, 7)


def test_duplicate_count(dq, spark):
    r = PR.duplicate_count(dq).collect()[0]
    assert (r.total, r.distinct_rows, r.duplicate_count) == (8, 7, 1)
    e = PR.duplicate_count(spark.createDataFrame([], "a int")).collect()[0]
    assert e.duplicate_count == 0
    nan = spark.createDataFrame([(float("nan"), None)] * 3, "a double, b string")
    assert PR.duplicate_count(nan).collect()[0].duplicate_count == 2


def test_describe_skew_kurt_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (None, 5.0)], "x double, c double")
    d = {r.column: r for r in PR.describe(df).collect()}
    assert d["x"]["count"] == 3 and d["x"].mean == pytest.approx(7 / 3)
    sk = {r.column: r for r in PR.skew_kurt(df).collect()}
    assert sk["c"].skewness is None and sk["c"].kurtosis is None
    x = np.array([1.0, 2.0, 4.0])
    m = x.mean()
    assert sk["x"].skewness == pytest.approx(((x - m) ** 3).mean() / ((x - m) ** 2).mean() ** 1.5)


def test_value_and_distinct_counts(dq):
    vc = {(r.column, r.value): r["count"] for r in PR.value_counts(dq, ["category"]).collect()}
    assert vc[("category", None)] == 1 and vc[("category", "C")] == 2
    dc = {r.column: (r.non_null_count, r.distinct_count) for r in PR.distinct_counts(dq).collect()}
    assert dc["category"] == (7, 5) and dc["id"] == (8, 7)
    assert PR.distinct_values(dq, "category").count() == 6


def test_profile_types(dq):
    p = {r.column: r for r in PR.profile(dq).collect()}
    assert p["score"].nans == 1 and p["score"].nulls == 1 and p["score"].max == "1000.0"
    assert p["name"].mean is None and p["name"].distinct == 6
    assert p["join_date"].data_type == "timestamp_ntz"


def test_quality_report(dq):
    rep = {(r.column, r.metric): r.value for r in
           PR.quality_report(dq, ts_hi="2030-01-01 00:00:00").collect()}
    assert rep[("join_date", "timestamp_issues")] == 3
    assert rep[("join_date", "format_issues")] == 1
    assert rep[(None, "duplicate_count")] == 1
    assert ("name", "skewness") not in rep and ("age", "outlier_issues") in rep


def test_correlation_matrix(spark):
    rnd = random.Random(7)
    rows = [(x, 2 * x + rnd.random(), 5.0) for x in (rnd.random() for _ in range(200))]
    df = spark.createDataFrame(rows + [(None, 1.0, 5.0), (float("nan"), 2.0, 5.0)], "a double, b double, c double")
    cm = {(r.column_x, r.column_y): r.correlation for r in D.correlation_matrix(df).collect()}
    a = np.array([r[0] for r in rows])
    b = np.array([r[1] for r in rows])
    assert cm[("a", "b")] == pytest.approx(np.corrcoef(a, b)[0, 1])
    assert cm[("a", "b")] == cm[("b", "a")]
    assert cm[("a", "c")] is None and cm[("a", "a")] == pytest.approx(1.0)


def test_histogram_counts_sum_to_non_null(spark):
    vals = [float(v) for v in range(100)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = D.histogram(df, ["x"], bins=10).collect()
    assert sum(r["count"] for r in h) == 100 and max(r.bucket for r in h) == 10
    const = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert sorted((r.bucket, r["count"]) for r in D.histogram(const, ["x"]).collect()) == [
        (1, 4), *((b, 0) for b in range(2, 11))]
    inf = float("inf")
    odd = spark.createDataFrame([(-inf,), (0.0,), (9.0,), (10.0,), (inf,), (inf,)], "x double")
    got = {r.bucket: (r.lower, r["count"]) for r in D.histogram(odd, ["x"]).collect()}
    assert got[1] == (0.0, 2) and got[5] == (4.0, 0) and got[10] == (9.0, 4) and len(got) == 10
    none = spark.createDataFrame([(None,)], "x double")
    assert sorted((r.bucket, r.lower, r["count"]) for r in D.histogram(none, ["x"], 2).collect()) == [(1, None, 0), (2, None, 0)]


def test_density_integrates_to_about_one(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(2000)], "x double")
    d = sorted(D.density_curve(df, ["x"], points=200).collect(), key=lambda r: r.point)
    area = sum((d[i + 1].x - d[i].x) * (d[i].density + d[i + 1].density) / 2 for i in range(len(d) - 1))
    assert 0.95 < area < 1.01


def test_box_stats_matches_numpy(spark):
    rnd = random.Random(11)
    vals = [rnd.expovariate(0.1) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = D.box_stats(df, ["x"]).collect()[0]
    q1, q2, q3 = np.percentile(vals, [25, 50, 75])
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, q2, q3))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    arr = np.array(vals)
    assert r.upper_whisker == arr[arr <= hi].max() and r.lower_whisker == arr[arr >= lo].min()
    assert r.outliers == int(((arr < lo) | (arr > hi)).sum())


@pytest.mark.parametrize("hot_share", [0.0, 0.34])
def test_exact_quantiles_many_rounds(spark, hot_share):
    rnd = random.Random(5)
    n = 20000
    vals = [7.0 if rnd.random() < hot_share else rnd.random() * 1000 for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    # tiny sketch and collect limit force several bracketing rounds
    got = exact_quantiles(df, "x", probs, accuracy=50, collect_limit=300)
    assert got == pytest.approx(list(np.percentile(vals, [p * 100 for p in probs])))
    lower = exact_quantiles(df, "x", [0.5], method="lower", accuracy=50, collect_limit=300)
    assert lower[0] == sorted(vals)[math.floor((n - 1) * 0.5)]


def test_statistical_analysis_exact_median(spark):
    vals = [1.0, 2.0, 3.0, 10.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = PR.statistical_analysis(df, ["x"], exact=True).collect()[0]
    assert r.median == 2.5 and r.mean == 4.0
    assert PR.statistical_analysis(df, ["x"], exact=True, method="lower").collect()[0].median == 2.0
    assert PR.statistical_analysis(df, ["x"]).collect()[0].median == 2.0


def test_reports_on_empty_one_row_all_null_constant(spark):
    empty = spark.createDataFrame([], "x double, s string, t timestamp_ntz")
    rep = {(r.column, r.metric): r.value for r in PR.quality_report(empty).collect()}
    assert rep[("x", "null_count")] == 0 and rep[("x", "outlier_issues")] == 0 and rep[(None, "duplicate_count")] == 0
    assert rep[("x", "skewness")] is None
    prof = {r.column: r for r in PR.profile(empty).collect()}
    assert prof["x"].rows == 0 and prof["x"].mean is None and prof["s"].distinct == 0
    one = spark.createDataFrame([(1.0, "a", None)], "x double, s string, t timestamp_ntz")
    d = PR.describe(one).collect()[0]
    assert d["count"] == 1 and d.stddev is None
    r = {(r.column, r.metric): r.value for r in PR.quality_report(one).collect()}
    assert r[("t", "timestamp_issues")] == 1 and r[("x", "outlier_issues")] == 0
    const = spark.createDataFrame([(5.0, None)] * 15, "x double, n double")
    sk = {r.column: r for r in PR.skew_kurt(const).collect()}
    assert sk["x"].skewness is None and sk["n"].skewness is None
    cm = {(r.column_x, r.column_y): r.correlation for r in D.correlation_matrix(const).collect()}
    assert cm[("x", "x")] is None and cm[("x", "n")] is None
    assert D.box_stats(const, ["n"]).collect()[0].q1 is None
    assert D.density_curve(const, ["x"], points=3).collect()[0].density is None
    from tablewatch.operators import cleaning as C
    assert C.remove_outliers(const).count() == 15
    assert [r.n for r in C.impute_mean(const).collect()] == [None] * 15


def test_profile_exact_median(spark):
    vals = [5.0, 1.0, 9.0, 3.0, None, float("nan"), 7.0, 2.0]
    df = spark.createDataFrame([(v, "t") for v in vals], "x double, s string")
    p = {r.column: r for r in PR.profile(df, exact_median=True).collect()}
    present = sorted(v for v in vals if v is not None and v == v)
    assert p["x"].median == present[(len(present) - 1) // 2] and p["s"].median is None


def test_exact_quantiles_many_columns_share_rounds(spark):
    from tablewatch.plans.quantiles import exact_quantiles_many
    rnd = random.Random(9)
    rows = [(rnd.random() * 100, 7.0 if rnd.random() < 0.4 else rnd.random(), None) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_quantiles_many(df, ["a", "b", "c"], [0.1, 0.5, 0.9], accuracy=30, collect_limit=50)
    for i, n in enumerate("ab"):
        vals = [r[i] for r in rows]
        assert got[n] == pytest.approx(list(np.percentile(vals, [10, 50, 90])))
    assert got["c"] == [None, None, None]
