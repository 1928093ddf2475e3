"""Radix selection, sketches in two levels and digest duplicates against brute force."""
import math
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewatch.plans import checks as K
from tablewatch.plans import distribution as D
from tablewatch.plans import profile as PR
from tablewatch.plans import quantiles as Q


def test_keys_of_doubles_are_their_bits(spark):
    rng = random.Random(1)
    xs = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan, None]
    xs += [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(1000)]
    xs += [m * 2.0 ** k for k in range(-1000, 1020, 7) for m in (1, 1 + 2.0 ** -52, 1 - 2.0 ** -53)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    key = Q.key_of(df, "x")
    got = sorted(r["key"] for r in Q.long_keys(df, {0: key}).collect())
    numbers = sorted(x for x in xs if x is not None and not math.isnan(x))
    assert [key.value(k) for k in got] == numbers and got == [key.of(x) for x in numbers]


@pytest.mark.parametrize("parts,few", [(4096, 4096), (300, 3)])
def test_wide_numbers_keep_every_digit(spark, parts, few):
    rng = random.Random(2)
    rows = [(9007199254740993 + rng.randrange(9) * 2 ** 40, Decimal(rng.randrange(-10 ** 37, 10 ** 37)).scaleb(-2), Decimal(rng.randrange(-999, 999)).scaleb(-2),
             rng.choice([-1, 1]) * 2 ** 63 // 2 + rng.randrange(99), Decimal(rng.randrange(10 ** 9)).scaleb(-20)) for _ in range(2001)]
    rows += [(None,) * 5] * 3 + [rows[0]] * 700
    df = spark.createDataFrame(rows, "a long, b decimal(38,2), c decimal(5,2), d long, e decimal(38,20)")
    got = Q.exact_quantiles_many(df, df.columns, [0, 0.3, 0.5, 1], "lower", parts, few)
    for i, c in enumerate(df.columns):
        have = sorted(r[i] for r in rows if r[i] is not None)
        assert got[c] == [have[math.floor((len(have) - 1) * p)] for p in (0, 0.3, 0.5, 1)]
    even = df.limit(0).unionByName(spark.createDataFrame([(2 ** 53 + 1,), (2 ** 53 + 4,)], "a long").selectExpr("a", *[f"CAST(NULL AS {t}) AS {c}" for c, t in df.dtypes[1:]]))
    row = PR.statistical_analysis(even, ["a", "b"], exact=True, median_as_text=True).collect()
    assert {r["column"]: r["median"] for r in row} == {"a": "9007199254740994.5", "b": None}


def jobs(spark, run):
    tracker, name = spark.sparkContext.statusTracker(), f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
        return len(tracker.getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_columns(spark):
    one = spark.range(5000).selectExpr("cast(id * 37 % 1000 as double) / 3 AS c0")
    many = one.select(*[(F.col("c0") + 0).alias(f"c{i}") for i in range(60)])
    assert jobs(spark, lambda: D.box_stats(many).collect()) == jobs(spark, lambda: D.box_stats(one).collect())
    assert len({tuple(r)[1:] for r in D.box_stats(many).collect()}) == 1


def test_box_stats_in_the_columns_type(spark):
    base = 9007199254740993
    df = spark.createDataFrame([(base + i, Decimal(base + i) / 4) for i in [*range(101), 1000]], "a long, d decimal(38,2)")
    out = {r["column"]: r for r in D.box_stats(df, as_text=True).collect()}
    assert tuple(out["a"])[1:] == ("9007199254741018.25", "9007199254741043.5", "9007199254741068.75", str(base), str(base + 100), 1)
    assert out["d"]["lower_whisker"] == str((Decimal(base) / 4).quantize(Decimal("0.01"))) and out["d"]["outliers"] == 1
    odd = spark.createDataFrame([(math.inf, None), (math.inf, None), (1.0, None), (-math.inf, math.nan)], "x double, y double")
    rows = {r["column"]: r for r in D.box_stats(odd).collect()}
    assert rows["y"]["q1"] is None and rows["y"]["outliers"] == 0 and rows["x"]["upper_whisker"] == math.inf


def test_sketches_merge_in_two_levels(spark):
    n = 200_000
    df = spark.range(0, n, 1, 90).select(F.col("id").alias("a"), F.when(F.col("id") % 2 == 0, F.sqrt("id")).alias("b"),
                                         F.lit(None).cast("double").alias("c"), F.lit(float("nan")).alias("d"))
    got = {r["column"]: r["value"] for r in Q.approx_quantiles(df, df.columns, 0.5, 1000).collect()}
    assert abs(got["a"] - n / 2) <= n / 1000 and abs(got["b"] ** 2 - n / 2) <= n / 1000 and got["c"] is None and got["d"] is None
    plan = Q.approx_quantiles(df, ["a"], 0.5, 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("kll_merge_agg_double") >= 1 and "% 64" in plan
    empty = PR.statistical_analysis(df.limit(0), ["a"]).collect()
    assert [(r["column"], r["median"]) for r in empty] == [("a", None)]
    with pytest.raises(ValueError):
        PR.statistical_analysis(df, ["a"], median_as_text=True)


def test_unequal_rows_of_equal_digest_are_told_apart(spark):
    # a null does not change the digest, so (null, "x") and ("x", null) share theirs
    rows = [(None, "x", 1.0), ("x", None, 1.0), ("x", None, 1.0), (None, None, 0.0), (None, None, -0.0), ("y", "z", math.nan), ("y", "z", math.nan)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    assert df.select(F.xxhash64("a", "b", "c")).distinct().count() < 4
    assert tuple(PR.duplicate_count(df).first()) == (7, 4, 3)
    assert tuple(K.key_counts(df.limit(0), ["a", "b"]).first()) == (0, 0)
    assert K._is_narrow(spark.range(1), ["id"]) and not K._is_narrow(df, ["a"])


def test_only_digests_of_wide_rows_are_shuffled(spark):
    df = spark.range(0, 4000, 1, 4).select(F.repeat(F.col("id").cast("string"), 500).alias("text"))
    plan = K.key_counts(df, ["text"])._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and tuple(K.key_counts(df, ["text"]).first()) == (4000, 4000)


def test_tolerance_counts_nan_as_equal(spark):
    df = spark.createDataFrame([(math.nan, math.nan), (1.0, 1.05), (1.0, 1.5), (math.nan, 1.0), (math.inf, math.inf), (None, 1.0)], "x double, y double")
    assert K.run_checks(df, [K.transformation(df, "x", F.col("y"), tolerance=0.1)]).first()["failing"] == 2
