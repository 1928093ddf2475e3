"""Awkward column names and nested types through the SQL-text built reports."""

import pytest
from pyspark.sql import functions as F

from tablewatch.plans import checks as K
from tablewatch.plans import distribution as D
from tablewatch.plans import profile as PR


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(float(i), float(i % 3) if i % 5 else None, f"v{i % 2}", [i, i + 1], {"k": i}) for i in range(20)]
    df = spark.createDataFrame(rows, "`a b` double, `c``d` double, `it's` string, arr array<int>, m map<string,int>")
    return df


def test_reports_quote_names(odd):
    nc = {r.column: r.null_count for r in PR.null_counts(odd).collect()}
    assert nc == {"a b": 0, "c`d": 4, "it's": 0, "arr": 0, "m": 0}
    d = {r.column: r for r in PR.describe(odd).collect()}
    assert d["a b"]["count"] == 20 and d["c`d"]["count"] == 16
    sk = {r.column for r in PR.skew_kurt(odd).collect()}
    assert sk == {"a b", "c`d"}
    prof = {r.column: r for r in PR.profile(odd).collect()}
    assert prof["it's"].distinct == 2 and prof["m"].distinct is None and prof["arr"].distinct == 20
    qr = {(r.column, r.metric): r.value for r in PR.quality_report(odd.drop("m")).collect()}
    assert qr[("c`d", "null_count")] == 4 and qr[(None, "duplicate_count")] == 0
    with pytest.raises(ValueError):
        PR.quality_report(odd)  # map column cannot be de-duplicated


def test_checks_and_distributions_quote_names(odd):
    res = {r.column: r for r in K.run_checks(odd, [K.value_range(odd, "a b", 0, 10), K.uniqueness(odd, "it's"),
                                                     K.outliers(odd, "c`d")]).collect()}
    assert res["a b"].failing == 9 and res["it's"].failing == 18 and res["c`d"].failing == 0
    cm = {(r.column_x, r.column_y) for r in D.correlation_matrix(odd).collect()}
    assert ("a b", "c`d") in cm
    assert sum(r["count"] for r in D.histogram(odd, ["c`d"]).collect()) == 16
    assert D.density_curve(odd, ["a b"], points=5).count() == 5
    assert PR.value_counts(odd, ["it's"]).count() == 2
    assert {r.column for r in PR.distinct_counts(odd, approx=True).collect()} == {"a b", "c`d", "it's", "arr"}
    with pytest.raises(ValueError):
        PR.distinct_counts(odd, ["m"])


def test_description_with_quote_in_message(spark):
    df = spark.createDataFrame([(1,)], "x int")
    c = K.Check("custom", "x", "n", bad=F.col("x") > 0, description="it's \\ odd")
    r = K.run_checks(df, [c]).collect()[0]
    assert r.message == "it's \\ odd: 1 of 1 rows"


def test_columns_named_like_internal_aliases(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (2, 5, 6)], "`__n` int, `__rows` int, `__total` int")
    assert PR.duplicate_count(df).collect()[0].duplicate_count == 1
    rep = {(r.column, r.metric): r.value for r in PR.quality_report(df).collect()}
    assert rep[(None, "duplicate_count")] == 1 and rep[("__rows", "null_count")] == 0
    res = K.run_checks(df, [K.uniqueness(df, "__n"), K.value_range(df, "__total", 0, 4)]).collect()
    assert sorted(r.failing for r in res) == [1, 1]
