"""Plan-shape guards: what must never appear in the physical plan of a registered query."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tablewatch.plans import checks as K
from tablewatch.plans import profile as PR

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "Window", "Expand"]


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_forbidden_operators(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF))
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name} plan contains {found}"


def test_scan_reads_only_needed_columns(spark):
    plan = _final_plan(E.queries()["value_range"](spark, SF))
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_outlier_removal_pushes_bounds_to_scan(spark):
    from tablewatch.operators import cleaning as C
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = C.remove_outliers(ev, ["value"], drop_null=True)
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value" in _final_plan(out)


def test_wide_table_batches(spark):
    n_cols = 250
    df = spark.range(50).select(*[(F.col("id") * (i + 1) % 7).cast("double").alias(f"c{i}") for i in range(n_cols)])
    nc = PR.null_counts(df).collect()
    assert len(nc) == n_cols and all(r.null_count == 0 for r in nc)
    prof = {r.column: r for r in PR.profile(df).collect()}
    assert len(prof) == n_cols and prof["c0"].distinct == 7
    res = K.run_checks(df, [K.value_range(df, f"c{i}", 0, 5) for i in range(n_cols)])
    rows = res.collect()
    assert len(rows) == n_cols
    expected = df.filter(F.col("c0") > 5).count()
    assert [r.failing for r in rows if r.column == "c0"] == [expected]
    rep = PR.quality_report(df)
    assert rep.count() == 3 * n_cols + 1
