import pytest
from pyspark.sql import functions as F

from tablewatch.operators import relational as R


def test_select_add_filter(dq):
    out = R.add_column(R.select_columns(dq, ["id", "salary"]), "salary_double", F.col("salary") * 2)
    rows = R.filter_rows(out, "salary_double > 100000").orderBy("id").collect()
    assert [r.id for r in rows] == [2, 2, 5, 7]


def test_cast_columns_try_and_raise(dq):
    out = R.cast_columns(dq, {"name": "int", "age": "double"})
    assert out.columns == dq.columns
    vals = {r.id: r.name for r in out.collect()}
    assert vals[4] == 42 and vals[1] is None
    with pytest.raises(Exception):
        R.cast_columns(dq, {"name": "int"}, on_error="raise").collect()


def test_columns_of_type(dq):
    assert R.columns_of_type(dq, "numeric").columns == ["id", "age", "salary", "score"]
    assert R.columns_of_type(dq, "timestamp").columns == ["join_date"]


def test_join_types(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (3, 30), (None, 0)], "k int, b int")
    assert R.join(a, b, "k").count() == 1  # NULL keys never match
    assert R.join(a, b, "k", "left").count() == 3
    assert R.join(a, b, "k", "full").count() == 5
    assert R.join(a, b, "k", "semi").count() == 1
    assert R.join(a, b, "k", "anti").count() == 2
    assert R.join(a, b, "k", "cross").count() == 1  # keyed cross = inner
    full = sorted(map(tuple, R.join(a, b, "k", "full").collect()), key=str)
    safe = sorted(map(tuple, R.join(a, b, "k", "full", skew_safe=True).select("k", "a", "b").collect()), key=str)
    assert full == safe
    with pytest.raises(ValueError):
        R.join(a, b, None, "cross")
    with pytest.raises(ValueError):
        R.join(a, b, "k", "sideways")


def test_group_by_agg(dq):
    out = R.group_by_agg(dq, ["category"], {"salary": ["avg", "max"], "age": "count"})
    assert set(out.columns) == {"category", "salary_avg", "salary_max", "age_count"}
    rows = {r.category: r for r in out.collect()}
    assert rows[None].salary_avg is None  # NULL is a group
    assert rows["C"].salary_max == 999999
    glob = R.group_by_agg(dq, [], {"id": "sum"}).collect()
    assert glob[0].id_sum == 30
    with pytest.raises(ValueError):
        R.group_by_agg(dq, ["category"], {"salary": "avg); drop table x; --"})


def test_remove_duplicates_keep_by(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z"), (2, 5, "y")],
                               "k int, o int, v string")
    first = {r.k: (r.o, r.v) for r in R.remove_duplicates(df, ["k"], keep_by=["o"]).collect()}
    last = {r.k: (r.o, r.v) for r in R.remove_duplicates(df, ["k"], keep_by=["o"], keep="last").collect()}
    assert first == {1: (1, "a"), 2: (5, "y")}  # ties broken by the remaining columns
    assert last == {1: (3, "c"), 2: (5, "z")}
    assert R.remove_duplicates(df).count() == 5
    assert R.remove_duplicates(df, ["k"]).count() == 2


def test_remove_duplicates_map_column_raises(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    with pytest.raises(ValueError):
        R.remove_duplicates(df)
    assert R.remove_duplicates(df, ["k"]).count() == 1


def test_names_with_spaces_and_backticks(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c``d` int")
    out = R.group_by_agg(df, [], {"a b": "sum", "c`d": "max"})
    assert out.collect()[0][0] == 1


def test_star_and_nested_columns(spark):
    df = spark.createDataFrame([((1, "u"), 2), ((3, "u"), 4)], "s struct<p:int,q:string>, `t.x` int")
    assert R.select_columns(df, "*").columns == ["s", "t.x"]
    assert R.select_columns(df, ["s.p", "t.x"]).columns == ["p", "t.x"]  # an exact top-level name wins
    assert R.select_columns(df, "s.*").columns == ["p", "q"]
    out = R.group_by_agg(df, "s.q", {"*": "count", "s.p": "sum", "t.x": "max"})
    assert out.columns == ["q", "*_count", "s.p_sum", "t.x_max"]
    assert [tuple(r) for r in out.collect()] == [("u", 2, 4, 4)]
    with pytest.raises(ValueError):
        R.group_by_agg(df, [], {"*": "sum"})


@pytest.mark.parametrize("how", ["inner", "left", "left_outer", "right", "rightouter", "full", "outer", "semi", "left_anti"])
def test_skew_safe_joins_give_the_plain_rows(spark, how):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n"), (1, "z"), (1, "z")], "k int, v string")
    b = spark.createDataFrame([(1, 10, "q"), (1, 11, "q"), (3, 30, "r"), (None, 0, "t")], "k long, b int, v string")
    safe, plain = R.join(a, b, "k", how), R.join(a, b, "k", how, skew_safe=False)
    assert safe.columns == plain.columns and safe.dtypes == plain.dtypes
    assert sorted(map(str, safe.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("how", ["left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_hot_key_is_split_on_either_side(spark, how, hot_side):
    hot = spark.range(60_000).select((F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                     F.col("id").alias("x"), F.lit("some text to give the rows a size").alias("pad"))
    keys = spark.range(0, 60_000, 3).select(F.col("id").alias("k"), F.col("id").alias("y"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.shuffle.partitions": "20"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = R.join(hot, keys, "k", how) if hot_side == "left" else R.join(keys, hot, "k", how)
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the distinct keys of a hot right side are one row each: nothing is left to split there
        assert "skew=true" in plan or (hot_side == "right" and how in ("semi", "anti"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_conditions_without_an_equality_are_refused(spark):
    a, b = spark.range(5).toDF("k"), spark.range(5).toDF("j")
    assert R.join(a, b, a.k == b.j).count() == 5
    for condition in (F.lit(True), a.k < b.j):
        with pytest.raises(ValueError):
            R.join(a, b, condition)
