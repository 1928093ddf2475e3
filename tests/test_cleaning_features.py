import pytest
from pyspark.sql import functions as F

from tablewatch.operators import cleaning as C
from tablewatch.operators import features as FE


def test_drop_missing_counts_nan(dq):
    assert C.drop_missing(dq, ["score"]).count() == 6
    assert C.drop_missing(dq, ["age"]).count() == 6
    assert C.drop_missing(dq).count() == 4
    assert C.handle_missing(dq, "drop", ["age"]).count() == 6


def test_fill_constant_type_checks(dq):
    out = C.fill_constant(dq, {"age": 18.33, "name": "n/a", "score": 0.5})
    rows = {r.id: r for r in out.collect()}
    assert rows[2].age == 18 and rows[3].name == "n/a" and rows[3].score == 0.5 and rows[4].score == 0.5
    with pytest.raises(ValueError):
        C.fill_constant(dq, {"salary": "default_value"})


def test_fill_defaults_and_unknown_strategy(dq):
    out = C.handle_missing(dq, "fill")
    r3 = [r for r in out.collect() if r.id == 3][0]
    assert r3.name == "" and r3.age == 17 and r3.salary == 0 and r3.score == 0.0 and r3.join_date is None
    with pytest.raises(ValueError):
        C.handle_missing(dq, "interpolate")


def test_impute_mean(dq, spark):
    out = {r.id: r for r in C.impute_mean(dq, ["age", "score", "salary"]).collect()}
    ages = [30, 17, 66, 40, 65, 18]
    assert out[2].age == int(sum(ages) / len(ages))  # truncated to int
    scores = [1.0, 2.0, 2.0, 3.0, 2.5, 1000.0]
    assert out[3].score == pytest.approx(sum(scores) / len(scores))
    assert out[4].score == pytest.approx(sum(scores) / len(scores))
    all_null = spark.createDataFrame([(None,), (None,)], "x double")
    assert [r.x for r in C.impute_mean(all_null).collect()] == [None, None]


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")


def test_remove_outliers_keeps_missing_and_matches_count(spark):
    from tablewatch.plans import checks as K
    vals = [float(i % 5) for i in range(40)] + [500.0, None, float("nan")]
    df = _frame(spark, vals)
    kept = C.remove_outliers(df, ["x"])
    assert kept.count() == 42  # only 500 removed; NULL and NaN kept
    n_out = K.run_checks(df, [K.outliers(df, "x")]).collect()[0].failing
    assert df.count() - kept.count() == n_out
    assert C.remove_outliers(df, ["x"], drop_null=True).count() == 40


def test_remove_outliers_sequential_differs(spark):
    rows = [(float(i % 7), float(i % 7) * (1 + i % 3)) for i in range(60)] + [(40.0, 1.0), (3.0, 300.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    one = C.remove_outliers(df, ["a", "b"]).count()
    seq = C.remove_outliers(df, ["a", "b"], sequential=True, drop_null=True).count()
    assert one == 60 and seq <= one


def test_timestamp_parts(dq):
    out = FE.timestamp_parts(dq)
    assert out.columns[-4:] == ["join_date_year", "join_date_month", "join_date_day", "join_date_hour"]
    r = [x for x in out.collect() if x.id == 6][0]
    assert (r.join_date_year, r.join_date_month, r.join_date_day, r.join_date_hour) == (2022, 2, 2, 23)


def test_one_hot(dq):
    out = FE.one_hot(dq, ["category"])
    new = [c for c in out.columns if c not in dq.columns]
    assert new == ["category_None", "category_A", "category_A_b", "category_A_b_2", "category_C", "category_a_2"]
    rows = out.select(*new).collect()
    assert all(sum(r) == 1 for r in rows)  # exactly one indicator per row
    assert sum(r.category_None for r in rows) == 1
    with pytest.raises(ValueError):
        FE.one_hot(dq, ["category"], max_categories=3)


def test_one_hot_default_all_strings(dq):
    out = FE.one_hot(dq)
    assert "name_Ann" in out.columns and "category_C" in out.columns
