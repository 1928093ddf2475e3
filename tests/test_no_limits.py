"""Nothing is cut off by a count: failures, categories, empty lists."""
from decimal import Decimal

import pytest

from tablewatch.operators import features as FE
from tablewatch.plans import checks as K
from tablewatch.plans import profile as PR
from tablewatch.plans import results as RS


def test_every_failure_is_raised(spark):
    df = spark.createDataFrame([(1, 120)], "failing long, total long").selectExpr("explode(sequence(1, 120)) AS i").selectExpr(
        "'c' AS check", "format_string('%03d', i) AS column", "'m' AS metric", "'fail' AS status", "concat('bad ', i) AS message")
    with pytest.raises(RS.CheckFailed) as e:
        RS.raise_on_failure(df)
    assert str(e.value).count("bad ") == 120


def test_one_hot_of_many_categories(spark):
    df = spark.range(1001).selectExpr("id", "concat('v', id) AS c")
    assert len(FE.one_hot(df, ["c"]).columns) == 1003
    with pytest.raises(ValueError):
        FE.one_hot(df, ["c"], max_categories=1000)


def test_one_hot_long(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y z", "q")], "id long, a string, b string")
    got = [tuple(r) for r in FE.one_hot_long(df, ["id"]).collect()]
    assert got == [(1, "a", "x"), (1, "b", None), (2, "a", "y z"), (2, "b", "q")]


def test_empty_list_allows_nothing(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    assert K.run_checks(df, [K.allowed_values(df, "c", [])]).first()["failing"] == 2


def test_a_check_that_cannot_run_is_an_alert(spark):
    from tablewatch.compat import ErrorHandling

    sent = []
    handler = ErrorHandling.__new__(ErrorHandling)
    handler.log_error = handler.log_info = lambda *_: None
    handler.send_notification = lambda title, text: sent.append(text)
    handler.check_null_values(spark.range(1), ["absent"])
    handler.check_inconsistent_data(spark.range(1), "id", "absent")
    assert len(sent) == 2 and all("did not run" in x for x in sent)


def test_distinct_counts_have_one_plan_for_every_width(spark):
    df = spark.range(20).selectExpr(*[f"id % {i + 1} AS c{i}" for i in range(40)])
    out = PR.distinct_counts(df)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.column: r.distinct_count for r in out.collect()} == {f"c{i}": min(i + 1, 20) for i in range(40)}


def test_extremes_keep_every_digit(spark):
    df = spark.createDataFrame([(1, Decimal("12345678901234567890.12")), (9007199254740993, None)], "b long, d decimal(38,2)")
    for report in (PR.describe(df), PR.profile(df)):
        got = {r.column: (r.min, r.max) for r in report.collect()}
        assert got == {"b": ("1", "9007199254740993"), "d": ("12345678901234567890.12",) * 2}


def test_text_beside_whole_numbers(spark):
    rows = [("2.7", 1), ("5000000000", 1), ("1e30", 1), ("1.0", 1), (" 1 ", 1), ("1e0", 1), ("one", 1), ("", 1), (None, 1)]
    df = spark.createDataFrame(rows, "t string, i int")
    assert K.run_checks(df, [K.consistency(df, "t", "i"), K.consistency(df, "i", "t")]).agg({"failing": "sum"}).first()[0] == 6
