import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.plans import checks as K
from tablewatch.plans import results as RS


def _by(results):
    return {(r.check, r.column): r for r in results.collect()}


def test_completeness_counts_nan_only_for_floats(dq):
    res = _by(K.run_checks(dq, K.completeness(dq)))
    assert res[("completeness", "score")].failing == 2  # NULL + NaN
    assert res[("completeness", "age")].failing == 2
    assert res[("completeness", "id")].failing == 0
    assert res[("completeness", "id")].status == "pass"
    assert res[("completeness", "score")].total == 8


def test_value_range_bounds_valid_and_null_not_counted(dq):
    res = _by(K.run_checks(dq, [K.value_range(dq, "age", 18, 65), K.value_range(dq, "salary", 30000, 200000),
                                 K.value_range(dq, "score", 0.0, 100.0)]))
    assert res[("value_range", "age")].failing == 2  # 17, 66
    assert res[("value_range", "salary")].failing == 2  # 42, 999999
    assert res[("value_range", "score")].failing == 2  # NaN is above every number, 1000


def test_consistency_mixed_types_try_cast(dq):
    res = K.run_checks(dq, [K.consistency(dq, "name", "salary")]).collect()[0]
    assert res.failing == 0  # only '42' converts, and 42 == 42


def test_allowed_values_null_in_list_ignored(dq):
    res = _by(K.run_checks(dq, [K.allowed_values(dq, "category", ["A", "C", None])]))
    assert res[("allowed_values", "category")].failing == 4  # 'A b' x2, 'A_b', 'a'
    strict = K.run_checks(dq, [K.allowed_values(dq, "category", ["A", "C"], allow_null=False)]).collect()[0]
    assert strict.failing == 5
    empty = K.run_checks(dq, [K.allowed_values(dq, "category", [], allow_null=False)]).collect()[0]
    assert empty.failing == 8


def test_uniqueness_and_duplicates(dq):
    res = _by(K.run_checks(dq, [K.uniqueness(dq, "id"), K.uniqueness(dq, "category"), K.duplicates(dq)]))
    assert res[("uniqueness", "id")].failing == 1
    assert res[("uniqueness", "category")].failing == 2  # A b twice, C twice; NULL is one value
    assert res[("duplicates", None)].failing == 1


def test_transformation_null_semantics(dq):
    df = dq.withColumn("salary_double", F.col("salary") * 2)
    res = K.run_checks(df, [K.transformation(df, "salary_double", F.col("salary") * 2)]).collect()[0]
    assert res.failing == 0
    df2 = df.withColumn("salary_double", F.when(F.col("id") == 1, None).otherwise(F.col("salary_double")))
    assert K.run_checks(df2, [K.transformation(df2, "salary_double", F.col("salary") * 2)]).collect()[0].failing == 0
    ns = K.run_checks(df2, [K.transformation(df2, "salary_double", F.col("salary") * 2, null_safe=True)])
    assert ns.collect()[0].failing == 1


def test_timestamp_range(dq):
    res = K.run_checks(dq, [K.timestamp_range(dq, "join_date", hi="2030-01-01 00:00:00")]).collect()[0]
    assert res.failing == 3  # NULL, 1850, 2999
    now = K.run_checks(dq, [K.timestamp_range(dq, "join_date")]).collect()[0]
    assert now.failing == 3


def test_timestamp_format_strptime_semantics(spark):
    vals = ["2020-01-01 00:00:00", "2020-1-1 0:0:0", "2020-13-01 00:00:00", "2020-01-01 00:00:00x", None,
            "2021-02-29 10:00:00", "2020-02-29 10:00:00", "2020-01-01   00:00:00", " 2020-01-01 00:00:00",
            "2020-01-01 00:00:60"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    bad = df.select(K.timestamp_format(df, "t").bad.alias("b")).collect()
    assert [r.b for r in bad] == [False, False, True, True, True, True, False, False, True, True]


def test_timestamp_format_other_directives(spark):
    from tablewatch.functions.predicates import strptime_parse
    df = spark.createDataFrame([("03/07/24 01:02:03 PM.5",), ("13/07/24 01:02:03 PM.5",)], "t string")
    out = df.select(strptime_parse(F.col("t"), "%m/%d/%y %I:%M:%S %p.%f").alias("p")).collect()
    assert str(out[0].p) == "2024-03-07 13:02:03.500000"
    assert out[1].p is None


@pytest.mark.parametrize("fmt", ["%d-%b-%Y", "%a, %d %B %y %H:%M %z", "%Y-%j", "%c", "%x %X", "%H:%M %Z"])
def test_timestamp_format_agrees_with_python(spark, fmt):
    from tablewatch.functions.predicates import strptime_parse
    stamps = [dt.datetime(y, m, d, h, 59, 7, tzinfo=dt.UTC)
              for y, m, d, h in ((1999, 1, 9, 0), (2023, 5, 31, 13), (2024, 2, 29, 23), (2024, 12, 31, 12))]
    texts = {v for t in stamps for s in [t.strftime(fmt)] for v in (
        s, s.lower(), s + "x", s.replace("2", "3"), s.replace("May", "Jun"), s.replace("+0000", "Z"), s.replace("+00", "+24"))}
    df = spark.createDataFrame([(t,) for t in sorted(texts)] + [("",), ("2023-366",)], "t string")
    parsed = df.select("t", strptime_parse(F.col("t"), fmt).alias("p"))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    for row in parsed.collect():
        try:
            expected = dt.datetime.strptime(row.t, fmt).replace(tzinfo=None)
        except ValueError:
            expected = None
        assert row.p == expected, row.t


def test_outliers_need_twelve_rows(spark):
    df = spark.createDataFrame([(float(i % 3),) for i in range(30)] + [(100.0,), (None,), (float("nan"),)], "x double")
    res = K.run_checks(df, [K.outliers(df, "x")]).collect()[0]
    assert res.failing == 1
    one = spark.createDataFrame([(1.0,)], "x double")
    assert K.run_checks(one, [K.outliers(one, "x")]).collect()[0].failing == 0


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    res = K.run_checks(df, [K.value_range(df, "a", 0, 1), K.uniqueness(df, "b")]).collect()
    assert all(r.failing == 0 and r.total == 0 and r.value is None for r in res)


def test_results_consumers(dq):
    res = K.run_checks(dq, [K.value_range(dq, "age", 18, 65), K.completeness(dq, ["id"])])
    alerts = RS.alerts(res).collect()
    assert len(alerts) == 1 and alerts[0].title == "ETL Process Error"
    assert "2 of 8 rows" in alerts[0].text
    with pytest.raises(RS.CheckFailed) as e:
        RS.raise_on_failure(res)
    assert "age" in str(e.value)
    levels = sorted(r.level for r in RS.log_rows(res).collect())
    assert levels == ["ERROR", "INFO"]


def test_failing_rows_sample(dq):
    rows = K.failing_rows(dq, K.value_range(dq, "age", 18, 65), 5, order_by="id").collect()
    assert [r.id for r in rows] == [3, 4]
    dup = K.failing_rows(dq, K.uniqueness(dq, "id")).collect()
    assert [(r.id, r.occurrences) for r in dup] == [(2, 2)]


def test_schema_diff(spark, dq):
    from tests.conftest import DQ_SCHEMA
    assert {s for *_, s in K.schema_diff(dq, DQ_SCHEMA)} == {"ok"}
    expected = T.StructType([f for f in DQ_SCHEMA.fields if f.name != "score"]
                            + [T.StructField("extra", T.StringType())])
    expected.fields[0] = T.StructField("id", T.LongType())
    diff = {c: s for c, _, _, s in K.schema_diff(dq, expected)}
    assert diff["id"] == "type_mismatch" and diff["extra"] == "missing" and diff["score"] == "unexpected"
    assert K.schema_match(spark, dq, expected).count() == len(diff)


def test_checks_fused_into_one_scan(dq, spark):
    res = K.run_checks(dq, K.completeness(dq) + [K.value_range(dq, "age", 18, 65)])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_append_results_sink(spark, dq):
    import tempfile
    path = tempfile.mkdtemp(prefix="tw-results-")
    res = K.run_checks(dq, [K.value_range(dq, "age", 18, 65)])
    RS.append_results(res, path, run_id="r1")
    RS.append_results(res, path, run_id="r2")
    back = spark.read.parquet(path)
    assert back.count() == 2 and {r.run_id for r in back.collect()} == {"r1", "r2"}
    assert "run_at" in back.columns
    RS.append_results(res.union(res), path, run_id="r2")  # the run is repeated
    RS.append_results(res.limit(0), path, run_id="r3")
    back = spark.read.parquet(path)
    assert sorted(r.run_id for r in back.collect()) == ["r1", "r2", "r2"]
    plain = tempfile.mkdtemp(prefix="tw-results-")
    RS.append_results(res, plain)
    RS.append_results(res, plain)
    assert spark.read.parquet(plain).count() == 2


def test_every_constructor_takes_a_severity(spark):
    df = spark.sql("SELECT 1.0D AS a, 2.0D AS b, 'x' AS t, timestamp'1800-01-01' AS ts UNION ALL SELECT 1.0D, 2.0D, 'x', timestamp'1800-01-01'")
    checks = [*K.completeness(df, severity="warning"), K.consistency(df, "a", "b", severity="warning"),
              K.value_range(df, "a", 5, 6, severity="warning"), K.uniqueness(df, "a", severity="warning"),
              K.duplicates(df, severity="warning"), K.transformation(df, "a", 3.0, severity="warning"),
              K.allowed_values(df, "t", ["y"], severity="warning"), K.timestamp_range(df, "ts", severity="warning"),
              K.timestamp_format(df, "t", severity="warning"), *K.timestamp_checks(df, severity="warning"),
              K.outliers(df, "a", severity="warning")]
    assert {c.severity for c in checks} == {"warning"}
    got = {(r["status"], r["severity"]) for r in K.run_checks(df, checks).collect()}
    assert ("fail", "warning") in got and ("fail", "error") not in got


def test_schema_nullable_and_order_flags(spark):
    df = spark.createDataFrame([(1, "a")], T.StructType([T.StructField("a", T.IntegerType(), False),
                                                         T.StructField("b", T.StringType(), True)]))
    exp = T.StructType([T.StructField("b", T.StringType(), True), T.StructField("a", T.IntegerType(), True)])
    assert {s for *_, s in K.schema_diff(df, exp)} == {"ok"}
    assert dict((c, s) for c, _, _, s in K.schema_diff(df, exp, check_nullable=True))["a"] == "nullable_mismatch"
    assert {s for *_, s in K.schema_diff(df, exp, check_order=True)} == {"order_mismatch"}
