"""Property checks on random frames against brute force in Python."""

import math
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewatch.functions import predicates as P
from tablewatch.operators import cleaning as C
from tablewatch.operators import features as FE
from tablewatch.plans import checks as K
from tablewatch.plans import distribution as D
from tablewatch.plans import profile as PR
from tablewatch.plans.quantiles import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                             st.one_of(st.none(), st.sampled_from(["a", "b", "a b", "A"]))),
                   min_size=0, max_size=40)


@SETTINGS
@given(rows=rows_st)
def test_duplicates_and_uniqueness_match_python(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string")
    r = PR.duplicate_count(df).collect()[0]
    assert r.duplicate_count == len(rows) - len(set(rows))
    u = K.run_checks(df, [K.uniqueness(df, "s")]).collect()[0]
    assert u.failing == len(rows) - len({s for _, s in rows})


@SETTINGS
@given(vals=st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=12, max_size=60))
def test_outlier_count_plus_kept_is_n(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    kept = C.remove_outliers(df, ["x"]).count()
    flagged = K.run_checks(df, [K.outliers(df, "x")]).collect()[0].failing
    assert kept + flagged == len(vals)


@SETTINGS
@given(rows=rows_st.filter(lambda r: len(r) > 0))
def test_one_hot_rows_sum_to_one(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string")
    out = FE.one_hot(df, ["s"])
    new = [c for c in out.columns if c not in ("k", "s")]
    assert all(sum(r) == 1 for r in out.select(*new).collect())


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.floats(-50, 50, allow_nan=False)), min_size=1, max_size=60),
       bins=st.integers(1, 7))
def test_histogram_counts_sum_to_non_null(spark, vals, bins):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = D.histogram(df, ["x"], bins=bins).collect()
    assert sum(r["count"] for r in h) == sum(v is not None for v in vals)
    assert all(1 <= r.bucket <= bins for r in h)


@SETTINGS
@given(vals=st.lists(st.integers(0, 30).map(float), min_size=1, max_size=300),
       p=st.floats(0, 1))
def test_exact_quantile_matches_numpy(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, "x", [p], accuracy=20, collect_limit=8)[0]
    assert got == pytest.approx(float(np.percentile(vals, p * 100)))
    low = exact_quantiles(df, "x", [p], method="lower", accuracy=20, collect_limit=8)[0]
    assert low == sorted(vals)[math.floor((len(vals) - 1) * p)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="0123456789+-. \t\n\x01ae ١x", max_size=8)),
                      min_size=1, max_size=80))
def test_text_try_cast_equals_try_cast(spark, texts):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from tablewatch.functions.predicates import text_try_cast
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for target in ["int", "bigint", "smallint", "tinyint"]:
        rows = df.select(F.col("s").try_cast(target).alias("a"),
                         text_try_cast(F.col("s"), T.StringType(), target).alias("b")).collect()
        assert all(r.a == r.b for r in rows), [(t, r.a, r.b) for t, r in zip(texts, rows) if r.a != r.b]


def test_iso_weeks_are_those_of_strptime(spark):
    from datetime import datetime

    rng = random.Random(7)
    for fmt in ("%G-W%V-%u", "%a %G %V", "%G %V %w %H:%M", "%u %d %G.%V %m", "%A, %V/%G"):
        texts = []
        for _ in range(400):
            values = {"G": f"{rng.choice([0, 1, 1970, 2004, 2015, 2020, 2024, 2026, 9999, rng.randint(1, 9998)]):04d}",
                      "V": rng.choice([f"{rng.randint(0, 54):02d}", str(rng.randint(1, 9)), "53", "52", "01"]), "u": str(rng.randint(0, 8)),
                      "w": str(rng.randint(0, 7)), "a": rng.choice(["Mon", "sun", "Thu", "Xyz"]), "A": rng.choice(["Friday", "MONDAY", "Sun"]),
                      "H": "23", "M": "59", "d": "31", "m": "02"}
            texts.append(re.sub("%(.)", lambda m, values=values: values[m[1]], fmt))

        def parsed(text, fmt=fmt):
            try:
                return datetime.strptime(text, fmt)
            except (ValueError, OverflowError):
                return None

        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = {r[0]: r[1] for r in df.select("t", P.strptime_parse(df["t"], fmt)).collect()}
        assert got == {t: parsed(t) for t in texts}
    for bad in ("%G %V", "%V %u", "%Y %V %u", "%G %V %u %j"):
        with pytest.raises(ValueError):
            P.strptime_regex(bad)
