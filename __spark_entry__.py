"""

Every query reads whole fixture tables (``{sf_dir}/{name}.parquet``) and runs one
operator (or the flagship pipeline) of the ``tablewatch`` package. The paired DuckDB
SQL computes the same result independently. Doubles are rounded on both sides (money
sums to 2 decimals, other statistics to 6) and integer types are cast to match.

Derived inputs (the fixtures have no NULL, NaN or duplicate rows): NULLs come from a
left join or ``NULLIF``, NaN from a ``CASE``, duplicates from projections.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the package lives next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tablewatch.operators import cleaning as C  # noqa: E402
from tablewatch.operators import features as FE  # noqa: E402
from tablewatch.operators import relational as R  # noqa: E402
from tablewatch.plans import checks as K  # noqa: E402
from tablewatch.plans import distribution as D  # noqa: E402
from tablewatch.plans import profile as PR  # noqa: E402
from tablewatch.plans import results as RS  # noqa: E402
from tablewatch.sources import preview as PV  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None):
    def wrap(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return wrap


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def _round(df: DataFrame, digits: int = 6, only=None) -> DataFrame:
    """Round every double column (or the ``only`` ones) for a stable comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (only is None or f.name in only):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def _results(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 6))


def _check_row_sql(check: str, column: str | None, metric: str, failing: str, total: str, description: str,
                   source: str, severity: str = "error") -> str:
    """DuckDB text of one result row; ``failing`` / ``total`` are aggregate SQL over ``source``."""
    col_sql = "NULL::VARCHAR" if column is None else f"'{column}'"
    desc = description.replace("'", "''")
    return f"""
SELECT '{check}' AS "check", {col_sql} AS "column", '{metric}' AS metric, f AS failing, t AS total,
       round(CASE WHEN t = 0 THEN NULL ELSE f / t END, 6) AS value,
       CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN f > 0 THEN '{severity}' ELSE 'info' END AS severity,
       '{desc}: ' || CAST(f AS VARCHAR) || ' of ' || CAST(t AS VARCHAR) || ' rows' AS message
FROM (SELECT CAST({failing} AS BIGINT) AS f, CAST({total} AS BIGINT) AS t FROM {source})"""


def _pred_row_sql(check, column, metric, pred, description, source, severity="error") -> str:
    return _check_row_sql(check, column, metric, f"count(*) FILTER (WHERE {pred})", "count(*)", description,
                          source, severity)


def _distinct_row_sql(check, column, metric, cols, description, source, severity="error") -> str:
    failing = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {source}))"
    return _check_row_sql(check, column, metric, failing, "count(*)", description, source, severity)


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(p.strip() for p in parts)


# ===========================================================================
# 1. flagship: join -> null handling -> dedupe -> cast -> group -> having -> derive

def flagship_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer").withColumnRenamed("c_custkey", "custkey")
    orders = _t(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    df = R.join(cust, orders, "custkey", "inner")
    df = R.add_column(df, "o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    df = C.handle_missing(df, "drop", subset=["o_orderstatus"])
    df = R.add_column(df, "order_year", F.year("o_orderdate"))
    df = R.select_columns(df, ["custkey", "order_year", "c_nationkey", "o_orderdate", "o_orderkey",
                               "o_totalprice"])
    df = R.remove_duplicates(df, subset=["custkey", "order_year"], keep_by=["o_orderdate", "o_orderkey"])
    df = R.cast_columns(df, {"o_totalprice": "decimal(18,2)"})
    g = R.group_by_agg(df, ["c_nationkey"], {"o_totalprice": "avg"})
    g = R.filter_rows(g, "o_totalprice_avg > 250000")
    g = R.select_columns(g, ["c_nationkey", "o_totalprice_avg"])
    g = R.add_column(g, "o_totalprice_double_avg", F.expr("o_totalprice_avg * 2"))
    return g.select("c_nationkey",
                    F.round(F.col("o_totalprice_avg").cast("double"), 2).alias("o_totalprice_avg"),
                    F.round(F.col("o_totalprice_double_avg").cast("double"), 2).alias("o_totalprice_double_avg"))


_query("flagship_pipeline", """
WITH j AS (
  SELECT c.c_custkey AS custkey, c.c_nationkey, o.o_orderkey, o.o_orderdate,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS price, year(o.o_orderdate) AS order_year
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
  WHERE NULLIF(o.o_orderstatus, 'P') IS NOT NULL
), k AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY custkey, order_year
                                              ORDER BY o_orderdate, o_orderkey) AS rn FROM j) WHERE rn = 1
)
SELECT c_nationkey, round(avg(price)::DOUBLE, 2) AS o_totalprice_avg,
       round((avg(price) * 2)::DOUBLE, 2) AS o_totalprice_double_avg
FROM k GROUP BY c_nationkey HAVING avg(price) > 250000
""")(flagship_pipeline)


# ===========================================================================
# 2. relational operators

@_query("select_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_select(spark, sf):
    return R.select_columns(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@_query("add_column", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS disc_price,
       l_quantity * 2 AS qty_double
FROM lineitem""")
def q_add_column(spark, sf):
    df = R.add_columns(_t(spark, sf, "lineitem"), {
        "disc_price": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6),
        "qty_double": "l_quantity * 2"})
    return R.select_columns(df, ["l_orderkey", "l_linenumber", "disc_price", "qty_double"])


@_query("filter_rows", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_totalprice > 300000 AND o_orderstatus = 'F'""")
def q_filter(spark, sf):
    df = R.filter_rows(_t(spark, sf, "orders"), "o_totalprice > 300000 AND o_orderstatus = 'F'")
    return R.select_columns(df, ["o_orderkey", "o_orderstatus", "o_totalprice"])


@_query("cast_schema", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority,
       CAST(o_custkey AS VARCHAR) AS o_custkey
FROM orders""")
def q_cast(spark, sf):
    df = R.select_columns(_t(spark, sf, "orders"),
                          ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_custkey"])
    return R.cast_columns(df, {"o_orderkey": "int", "o_totalprice": "int", "o_orderdate": "date",
                               "o_orderpriority": "int", "o_custkey": "string"})


@_query("select_star", "SELECT *, n_name AS nation FROM nation")
def q_select_star(spark, sf):
    return R.select_columns(_t(spark, sf, "nation"), ["*", F.col("n_name").alias("nation")])


@_query("select_nested", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_select_nested(spark, sf):
    nested = _t(spark, sf, "orders").select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("head"))
    return R.select_columns(nested, ["o_orderkey", "head.*"])


@_query("columns_of_type", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_columns_of_type(spark, sf):
    return R.columns_of_type(_t(spark, sf, "orders"), "numeric")


def _orders_lines(spark, sf):
    orders = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    lines = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return orders, lines


def _unmatched(orders):
    """Every order; those of status P under a key that no line has."""
    return orders.withColumn("orderkey", F.expr("CASE WHEN o_orderstatus = 'P' THEN -orderkey ELSE orderkey END"))


_JOIN_SELECT = "SELECT orderkey, o_orderstatus, l_linenumber, l_quantity FROM"
_O = "(SELECT o_orderkey AS orderkey, o_orderstatus FROM orders)"
_O_NOT_P = ("(SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS orderkey, "
            "o_orderstatus FROM orders)")
_L = "(SELECT l_orderkey AS orderkey, l_linenumber, l_quantity FROM lineitem)"


@_query("join_inner", f"{_JOIN_SELECT} {_O} o JOIN {_L} l USING (orderkey)")
def q_join_inner(spark, sf):
    o, l_ = _orders_lines(spark, sf)
    return R.join(o, l_, "orderkey", "inner").select("orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


@_query("join_left", f"{_JOIN_SELECT} {_O} o LEFT JOIN {_L} l USING (orderkey)")
def q_join_left(spark, sf):
    o, l_ = _orders_lines(spark, sf)
    return R.join(o, l_, "orderkey", "left").select("orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


@_query("join_right", f"{_JOIN_SELECT} {_O_NOT_P} o RIGHT JOIN {_L} l USING (orderkey)")
def q_join_right(spark, sf):
    o, l_ = _orders_lines(spark, sf)
    o = _unmatched(o)
    return R.join(o, l_, "orderkey", "right").select("orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


@_query("join_full", f"{_JOIN_SELECT} {_O_NOT_P} o FULL JOIN {_L} l USING (orderkey)")
def q_join_full(spark, sf):
    o, l_ = _orders_lines(spark, sf)
    o = _unmatched(o)
    return R.join(o, l_, "orderkey", "full").select("orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


@_query("join_semi", f"SELECT orderkey, o_orderstatus FROM {_O} o SEMI JOIN {_L} l USING (orderkey)")
def q_join_semi(spark, sf):
    o, l_ = _orders_lines(spark, sf)
    return R.join(o, l_, "orderkey", "semi")


@_query("join_anti", f"SELECT orderkey, o_orderstatus FROM {_O} o ANTI JOIN {_L} l USING (orderkey)")
def q_join_anti(spark, sf):
    o, l_ = _orders_lines(spark, sf)
    return R.join(o, l_, "orderkey", "anti")


@_query("group_by_agg", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity_sum,
       round(avg(l_quantity), 6) AS l_quantity_avg, round(max(l_extendedprice), 6) AS l_extendedprice_max,
       round(avg(l_discount), 6) AS l_discount_avg, count(l_orderkey) AS l_orderkey_count
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_group_by(spark, sf):
    g = R.group_by_agg(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "l_quantity": ["sum", "avg"], "l_extendedprice": "max", "l_discount": "avg", "l_orderkey": "count"})
    return _round(_round(g, 2, only={"l_quantity_sum"}), 6)


@_query("group_by_count_star", """
SELECT l_returnflag, count(*) AS "*_count", round(sum(l_quantity), 2) AS "line.l_quantity_sum"
FROM lineitem GROUP BY l_returnflag""")
def q_group_by_count_star(spark, sf):
    lines = _t(spark, sf, "lineitem").select("l_returnflag", F.struct("l_quantity").alias("line"))
    g = R.group_by_agg(lines, ["l_returnflag"], {"*": "count", "line.l_quantity": "sum"})
    total = F.col("`line.l_quantity_sum`")
    return g.select("l_returnflag", "*_count", F.round(total, 2).alias("line.l_quantity_sum"))


@_query("group_by_global", """
SELECT round(sum(o_totalprice), 2) AS o_totalprice_sum, min(o_orderdate) AS o_orderdate_min,
       max(o_orderdate) AS o_orderdate_max FROM orders""")
def q_group_global(spark, sf):
    g = R.group_by_agg(_t(spark, sf, "orders"), [], {"o_totalprice": "sum", "o_orderdate": ["min", "max"]})
    return _round(g, 2)


@_query("remove_duplicates", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity DESC, l_shipdate DESC) AS rn
               FROM lineitem)
WHERE rn = 1""")
def q_remove_duplicates(spark, sf):
    df = R.select_columns(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])
    return R.remove_duplicates(df, subset=["l_orderkey"], keep_by=["l_linenumber"], keep="last")


@_query("drop_duplicates_subset", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_drop_duplicates_subset(spark, sf):
    df = R.remove_duplicates(_t(spark, sf, "lineitem"), subset=["l_returnflag", "l_linestatus"])
    return df.select("l_returnflag", "l_linestatus")


# ===========================================================================
# 3. fused checks

_DOC_LABELS = "(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def _doc_labels(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source")
    return R.join(docs, _t(spark, sf, "labels"), "doc_id", "left")


@_query("null_counts", _union(*[
    f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count
        FROM {_DOC_LABELS}""" for c in ["doc_id", "lang", "source", "quality", "toxic"]]))
def q_null_counts(spark, sf):
    return PR.null_counts(_doc_labels(spark, sf))


_LI_NAN = ("(SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0) AS l_discount, "
           "CASE WHEN l_tax = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax, l_quantity FROM lineitem)")


def _li_nan(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.expr("nullif(l_discount, 0)").alias("l_discount"),
                     F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
                     "l_quantity")


@_query("completeness_nan", _union(
    _pred_row_sql("completeness", "l_discount", "missing_count", "l_discount IS NULL OR isnan(l_discount)",
                  "Column l_discount contains missing values", _LI_NAN),
    _pred_row_sql("completeness", "l_tax", "missing_count", "l_tax IS NULL OR isnan(l_tax)",
                  "Column l_tax contains missing values", _LI_NAN),
    _pred_row_sql("completeness", "l_quantity", "missing_count", "l_quantity IS NULL OR isnan(l_quantity)",
                  "Column l_quantity contains missing values", _LI_NAN)))
def q_completeness(spark, sf):
    df = _li_nan(spark, sf)
    return _results(K.run_checks(df, K.completeness(df, ["l_discount", "l_tax", "l_quantity"])))


@_query("consistency", _pred_row_sql("consistency", "l_discount,l_tax", "mismatch_count", "l_discount <> l_tax",
                                     "Inconsistent data between columns l_discount and l_tax", "lineitem"))
def q_consistency(spark, sf):
    df = _t(spark, sf, "lineitem")
    return _results(K.run_checks(df, [K.consistency(df, "l_discount", "l_tax")]))


_ORDERS_TEXT_KEY = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR)
        WHEN 'O' THEN 'key-' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey + 1 AS VARCHAR) END AS key_text
        FROM orders)"""


_ORDERS_TEXT_NUMBER = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) || '.0'
        WHEN 'O' THEN CAST(o_orderkey AS VARCHAR) || '.7' ELSE '5000000000000000000000' END AS number_text
        FROM orders)"""


@_query("consistency_text_decimal", _pred_row_sql(
    "consistency", "number_text,o_orderkey", "mismatch_count", "CAST(number_text AS DECIMAL(38,1)) <> o_orderkey",
    "Inconsistent data between columns number_text and o_orderkey", _ORDERS_TEXT_NUMBER))
def q_consistency_text_decimal(spark, sf):
    text = F.expr("""CASE o_orderstatus WHEN 'F' THEN concat(o_orderkey, '.0') WHEN 'O' THEN concat(o_orderkey, '.7')
                     ELSE '5000000000000000000000' END""")
    df = _t(spark, sf, "orders").select("o_orderkey", text.alias("number_text"))
    return _results(K.run_checks(df, [K.consistency(df, "number_text", "o_orderkey")]))


@_query("consistency_mixed_types", _pred_row_sql(
    "consistency", "key_text,o_orderkey", "mismatch_count", "TRY_CAST(key_text AS BIGINT) <> o_orderkey",
    "Inconsistent data between columns key_text and o_orderkey", _ORDERS_TEXT_KEY))
def q_consistency_mixed(spark, sf):
    o = _t(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    df = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", key)
                  .when(F.col("o_orderstatus") == "O", F.concat(F.lit("key-"), key))
                  .otherwise((F.col("o_orderkey") + 1).cast("string")).alias("key_text"))
    return _results(K.run_checks(df, [K.consistency(df, "key_text", "o_orderkey")]))


@_query("value_range", _pred_row_sql("value_range", "l_quantity", "out_of_range_count",
                                     "l_quantity < 5 OR l_quantity > 45",
                                     "Column l_quantity lies partly outside [5, 45]", "lineitem"))
def q_value_range(spark, sf):
    df = _t(spark, sf, "lineitem")
    return _results(K.run_checks(df, [K.value_range(df, "l_quantity", 5, 45)]))


@_query("allowed_values", _union(
    _pred_row_sql("allowed_values", "o_orderstatus", "invalid_count",
                  "o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')",
                  "Column o_orderstatus has values outside the allowed set", "orders"),
    _pred_row_sql("allowed_values", "o_orderpriority", "invalid_count",
                  "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')",
                  "Column o_orderpriority has values outside the allowed set", "orders")))
def q_allowed_values(spark, sf):
    df = _t(spark, sf, "orders")
    return _results(K.run_checks(df, [
        K.allowed_values(df, "o_orderstatus", ["F", "O", None]),
        K.allowed_values(df, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
                         allow_null=False)]))


@_query("uniqueness", _union(
    _distinct_row_sql("uniqueness", "l_orderkey,l_linenumber", "duplicate_count", "l_orderkey, l_linenumber",
                      "Column l_orderkey,l_linenumber repeats key values", "lineitem"),
    _distinct_row_sql("uniqueness", "l_orderkey", "duplicate_count", "l_orderkey",
                      "Column l_orderkey repeats key values", "lineitem")))
def q_uniqueness(spark, sf):
    df = _t(spark, sf, "lineitem")
    return _results(K.run_checks(df, [K.uniqueness(df, ["l_orderkey", "l_linenumber"]),
                                      K.uniqueness(df, "l_orderkey")]))


_LI_QTY2 = ("(SELECT l_quantity, CASE WHEN l_linenumber = 7 THEN l_quantity * 2 + 1 ELSE l_quantity * 2 END "
            "AS qty2 FROM lineitem)")


@_query("verify_transformation", _pred_row_sql(
    "transformation", "qty2", "mismatch_count", "qty2 <> l_quantity * 2",
    "Derived column qty2 differs from its expression", _LI_QTY2))
def q_verify_transformation(spark, sf):
    li = _t(spark, sf, "lineitem")
    df = li.select("l_quantity", F.when(F.col("l_linenumber") == 7, F.col("l_quantity") * 2 + 1)
                   .otherwise(F.col("l_quantity") * 2).alias("qty2"))
    return _results(K.run_checks(df, [K.transformation(df, "qty2", F.col("l_quantity") * 2)]))


@_query("timestamp_range", _pred_row_sql(
    "timestamp_range", "o_orderdate", "invalid_count",
    "o_orderdate IS NULL OR o_orderdate < TIMESTAMP '1996-01-01 00:00:00' "
    "OR o_orderdate > TIMESTAMP '2001-01-01 00:00:00'",
    "Column o_orderdate has missing or implausible timestamps", "orders"))
def q_timestamp_range(spark, sf):
    df = _t(spark, sf, "orders")
    return _results(K.run_checks(df, [K.timestamp_range(df, "o_orderdate", "1996-01-01 00:00:00",
                                                        "2001-01-01 00:00:00")]))


# Text forms of o_orderdate, one per priority: standard, single-digit fields, day forced
# to 31 (invalid in short months), month 13 or trailing text, and NULL.
_ORDERS_TS_TEXT = """(SELECT o_orderkey, o_orderdate, CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%-m-%-d %-H:%-M:%-S')
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-31 %H:%M:%S')
    WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-13-%d %H:%M:%S')
                                     ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC' END
    ELSE NULL END AS ts_text FROM orders)"""
_STRPTIME_RE = (r"(\d\d\d\d)-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])\s+"
                r"(2[0-3]|[0-1]\d|\d):([0-5]\d|\d):(6[0-1]|[0-5]\d|\d)")


def _orders_ts_text(spark, sf):
    o = _t(spark, sf, "orders")
    ts, prio = F.col("o_orderdate"), F.col("o_orderpriority")
    std = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    text = (F.when(prio == "1-URGENT", std)
            .when(prio == "2-HIGH", F.date_format(ts, "yyyy-M-d H:m:s"))
            .when(prio == "3-MEDIUM", F.date_format(ts, "yyyy-MM-'31' HH:mm:ss"))
            .when(prio == "4-NOT SPECIFIED",
                  F.when(F.col("o_orderstatus") == "F", F.date_format(ts, "yyyy-'13'-dd HH:mm:ss"))
                  .otherwise(F.concat(std, F.lit(" UTC")))))
    return o.select("o_orderkey", "o_orderdate", text.alias("ts_text"))


@_query("timestamp_format", _union(
    _pred_row_sql("timestamp_format", "ts_text", "invalid_count",
                  f"NOT coalesce(regexp_full_match(ts_text, '{_STRPTIME_RE}') "
                  "AND try_strptime(ts_text, '%Y-%m-%d %H:%M:%S') IS NOT NULL, false)",
                  "Column ts_text has values not in format %Y-%m-%d %H:%M:%S", _ORDERS_TS_TEXT),
    _pred_row_sql("timestamp_format", "o_orderdate", "invalid_count", "o_orderdate IS NULL",
                  "Column o_orderdate has values not in format %Y-%m-%d %H:%M:%S", _ORDERS_TS_TEXT)))
def q_timestamp_format(spark, sf):
    df = _orders_ts_text(spark, sf)
    return _results(K.run_checks(df, [K.timestamp_format(df, "ts_text"), K.timestamp_format(df, "o_orderdate")]))


# The order's day with its month's name; forced to the 31st for one priority, without a year for another.
_ORDERS_DAY_TEXT = """(SELECT CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '31-%b-%Y') WHEN '2-HIGH' THEN strftime(o_orderdate, '%d-%b')
    ELSE strftime(o_orderdate, '%d-%b-%Y') END AS day_text FROM orders)"""


@_query("timestamp_format_month_name", _pred_row_sql(
    "timestamp_format", "day_text", "invalid_count", "day_text IS NULL OR try_strptime(day_text, '%d-%b-%Y') IS NULL",
    "Column day_text has values not in format %d-%b-%Y", _ORDERS_DAY_TEXT))
def q_timestamp_format_month_name(spark, sf):
    ts, prio = F.col("o_orderdate"), F.col("o_orderpriority")
    df = _t(spark, sf, "orders").select(
        F.when(prio == "1-URGENT", F.date_format(ts, "'31'-MMM-yyyy")).when(prio == "2-HIGH", F.date_format(ts, "dd-MMM"))
        .otherwise(F.date_format(ts, "dd-MMM-yyyy")).alias("day_text"))
    return _results(K.run_checks(df, [K.timestamp_format(df, "day_text", "%d-%b-%Y")]))


@_query("timestamp_checks_all", _union(
    _pred_row_sql("timestamp_range", "ts", "invalid_count",
                  "ts IS NULL OR ts < TIMESTAMP '1900-01-01 00:00:00' OR ts > TIMESTAMP '2024-01-15 00:00:00'",
                  "Column ts has missing or implausible timestamps", "events"),
    _pred_row_sql("timestamp_format", "ts", "invalid_count", "ts IS NULL",
                  "Column ts has values not in format %Y-%m-%d %H:%M:%S", "events")))
def q_timestamp_checks_all(spark, sf):
    df = _t(spark, sf, "events")
    return _results(K.run_checks(df, K.timestamp_checks(df, hi="2024-01-15 00:00:00")))


@_query("duplicate_count", """
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST((SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem))
            AS BIGINT) AS distinct_rows,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber
                                              FROM lineitem)) AS BIGINT) AS duplicate_count
FROM lineitem""")
def q_duplicate_count(spark, sf):
    return PR.duplicate_count(_t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@_query("duplicate_count_text", """
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST((SELECT count(DISTINCT text) FROM documents) AS BIGINT) AS distinct_rows,
       CAST(count(*) - (SELECT count(DISTINCT text) FROM documents) AS BIGINT) AS duplicate_count
FROM documents""")
def q_duplicate_count_text(spark, sf):
    return PR.duplicate_count(_t(spark, sf, "documents"), subset=["text"])


_EXPECTED_LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DecimalType(12, 2)), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_commitdate", T.DateType()),
])


_SCHEMA_SQL = """
WITH actual AS (
  SELECT column_name AS "column",
         CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
              WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' WHEN 'DATE' THEN 'date'
              ELSE lower(column_type) END AS actual_type
  FROM (DESCRIBE lineitem)
), expected("column", expected_type) AS (VALUES __EXPECTED__)
SELECT coalesce(e."column", a."column") AS "column", e.expected_type, a.actual_type,
       CASE WHEN a."column" IS NULL THEN 'missing' WHEN e."column" IS NULL THEN 'unexpected'
            WHEN e.expected_type <> a.actual_type THEN 'type_mismatch' ELSE 'ok' END AS status
FROM expected e FULL JOIN actual a ON e."column" = a."column"
""".replace("__EXPECTED__", ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')"
                                      for f in _EXPECTED_LINEITEM.fields))


@_query("schema_match", _SCHEMA_SQL)
def q_schema_match(spark, sf):
    return K.schema_match(spark, _t(spark, sf, "lineitem"), _EXPECTED_LINEITEM)


_SUITE_SRC = "(SELECT * FROM lineitem)"


@_query("check_suite", _union(
    _pred_row_sql("value_range", "l_quantity", "out_of_range_count", "l_quantity < 5 OR l_quantity > 45",
                  "Column l_quantity lies partly outside [5, 45]", _SUITE_SRC),
    _pred_row_sql("value_range", "l_discount", "out_of_range_count", "l_discount < 0.0 OR l_discount > 0.1",
                  "Column l_discount lies partly outside [0.0, 0.1]", _SUITE_SRC),
    _pred_row_sql("allowed_values", "l_returnflag", "invalid_count",
                  "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R')",
                  "Column l_returnflag has values outside the allowed set", _SUITE_SRC),
    _pred_row_sql("completeness", "l_shipdate", "missing_count", "l_shipdate IS NULL",
                  "Column l_shipdate contains missing values", _SUITE_SRC),
    _pred_row_sql("consistency", "l_discount,l_tax", "mismatch_count", "l_discount <> l_tax",
                  "Inconsistent data between columns l_discount and l_tax", _SUITE_SRC, "warning"),
    _distinct_row_sql("uniqueness", "l_orderkey,l_linenumber", "duplicate_count", "l_orderkey, l_linenumber",
                      "Column l_orderkey,l_linenumber repeats key values", _SUITE_SRC)))
def q_check_suite(spark, sf):
    return _results(_suite(spark, sf))


def _suite(spark, sf):
    df = _t(spark, sf, "lineitem")
    cons = K.consistency(df, "l_discount", "l_tax")
    cons = K.Check(cons.check, cons.column, cons.metric, bad=cons.bad, severity="warning",
                   description=cons.description)
    return K.run_checks(df, [
        K.value_range(df, "l_quantity", 5, 45), K.value_range(df, "l_discount", 0.0, 0.1),
        K.allowed_values(df, "l_returnflag", ["A", "N", "R"]), K.completeness(df, ["l_shipdate"]),
        cons, K.uniqueness(df, ["l_orderkey", "l_linenumber"])])


# every column in the sort key: (l_orderkey, l_linenumber) alone has ties in the fixtures
_LI_ALL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@_query("failing_rows", f"""
SELECT * FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45
ORDER BY {", ".join(_LI_ALL)} LIMIT 20""")
def q_failing_rows(spark, sf):
    df = _t(spark, sf, "lineitem")
    return K.failing_rows(df, K.value_range(df, "l_quantity", 5, 45), 20, order_by=_LI_ALL)


_ALL_FAILING = {("value_range", "l_quantity"): "l_quantity < 5 OR l_quantity > 45",
                ("value_range", "l_discount"): "l_discount < 0.0 OR l_discount > 0.05",
                ("uniqueness", "l_orderkey,l_linenumber"): "(l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) "
                                                           "FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"}


@_query("failing_rows_all", _union(*[f"""
SELECT * FROM (SELECT '{check}' AS "check", '{column}' AS "column",
                      CAST(row_number() OVER (ORDER BY {", ".join(_LI_ALL)}) AS INTEGER) AS place, {", ".join(_LI_ALL)}
               FROM lineitem WHERE {bad}) WHERE place <= 20""" for (check, column), bad in _ALL_FAILING.items()]))
def q_failing_rows_all(spark, sf):
    df = _t(spark, sf, "lineitem")
    checks = [K.value_range(df, "l_quantity", 5, 45), K.value_range(df, "l_discount", 0.0, 0.05),
              K.uniqueness(df, ["l_orderkey", "l_linenumber"])]
    return K.failing_rows_all(df, checks, 20, order_by=_LI_ALL).select("check", "column", "place", "row.*")


@_query("head", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_head(spark, sf):
    return PV.head(_t(spark, sf, "orders"), 5, order_by="o_orderkey")


# ===========================================================================
# 4. statistics and profiles

_NUM_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@_query("describe", _union(*[f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
       round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM lineitem""" for c in _NUM_LI]))
def q_describe(spark, sf):
    out = PR.describe(_t(spark, sf, "lineitem"), _NUM_LI)
    return _round(out.withColumns({c: F.col(c).cast("double") for c in ("min", "max")}))


_WIDE = {"big": "o_orderkey + 9007199254740993",
         "exact": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST('12345678901234567890.12' AS DECIMAL(30,2)) AS DECIMAL(38,2))"}


@_query("describe_wide_numbers", _union(*[f"""
SELECT '{c}' AS "column", count(*) AS count, CAST(min({e}) AS VARCHAR) AS min, CAST(max({e}) AS VARCHAR) AS max
FROM orders""" for c, e in _WIDE.items()]))
def q_describe_wide(spark, sf):
    df = _t(spark, sf, "orders").select(*[F.expr(e).alias(c) for c, e in _WIDE.items()])
    return PR.describe(df).select("column", "count", "min", "max")


def _skew_sql(c: str, src: str) -> str:
    return f"""
SELECT '{c}' AS "column",
       round((SELECT avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5)
              FROM {src}, (SELECT avg({c}) AS m FROM {src})), 6) AS skewness,
       round(kurtosis_pop({c}), 6) AS kurtosis FROM {src}"""


@_query("skew_kurt", _union(_skew_sql("value", "events"), _skew_sql("user_id", "events")))
def q_skew_kurt(spark, sf):
    return _round(PR.skew_kurt(_t(spark, sf, "events"), ["value", "user_id"]))


@_query("median_wide_numbers", _union(*[f"""
SELECT '{c}' AS "column", CAST(quantile_disc({e}, 0.5) AS VARCHAR) AS median FROM orders""" for c, e in _WIDE.items()]))
def q_median_wide(spark, sf):
    df = _t(spark, sf, "orders").select(*[F.expr(e).alias(c) for c, e in _WIDE.items()])
    return PR.statistical_analysis(df, list(_WIDE), exact=True, method="lower", median_as_text=True).select("column", "median")


# a median of sketches is right if the rows up to it, and those from it on, reach half of all within the bound
@_query("statistical_analysis_default", _union(*[f"""
SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, true AS median_within_bound
FROM lineitem""" for c in _NUM_LI]))
def q_statistical_analysis_default(spark, sf):
    df = _t(spark, sf, "lineitem")
    stats = PR.statistical_analysis(df, _NUM_LI)
    rows = df.selectExpr("inline(array(" + ", ".join(f"named_struct('name', '{c}', 'x', CAST({c} AS DOUBLE))" for c in _NUM_LI) + "))")
    ranks = rows.join(F.broadcast(stats), rows["name"] == stats["column"]).groupBy("column").agg(
        F.first("mean").alias("mean"), F.first("stddev").alias("stddev"), F.count("x").alias("n"),
        F.count_if(F.col("x") <= F.col("median")).alias("up_to"), F.count_if(F.col("x") >= F.col("median")).alias("from"))
    slack = F.col("n") / PR.DEFAULT_ACCURACY + 1
    return _round(ranks.select("column", "mean", "stddev", F.coalesce(
        (F.col("up_to") >= F.col("n") / 2 - slack) & (F.col("from") >= F.col("n") / 2 - slack), F.lit(False)).alias("median_within_bound")))


@_query("statistical_analysis", _union(*[f"""
SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(quantile_disc({c}, 0.5), 6) AS median,
       round(stddev_samp({c}), 6) AS stddev FROM lineitem""" for c in ["l_quantity", "l_discount"]]))
def q_statistical_analysis(spark, sf):
    # exact lower median: the oracle's quantile_disc at any scale (the library default is
    # percentile_approx, whose answer is only guaranteed within n/accuracy ranks)
    return _round(PR.statistical_analysis(_t(spark, sf, "lineitem"), ["l_quantity", "l_discount"], exact=True,
                                          method="lower"))


def _outlier_sql(c: str, src: str, k: float = 3.0) -> str:
    return _pred_row_sql(
        "outliers", c, "outlier_count",
        f"{c} > (SELECT avg({c}) + {k} * stddev_samp({c}) FROM {src}) "
        f"OR {c} < (SELECT avg({c}) - {k} * stddev_samp({c}) FROM {src})",
        f"Column {c} has values beyond {k} standard deviations", src)


@_query("outlier_count", _union(_outlier_sql("value", "events"), _outlier_sql("user_id", "events")))
def q_outlier_count(spark, sf):
    df = _t(spark, sf, "events")
    stats = K.numeric_stats(df, ["value", "user_id"])
    return _results(K.run_checks(df, [K.outliers(df, "value", stats=stats),
                                      K.outliers(df, "user_id", stats=stats)]))


@_query("outlier_count_documents", _outlier_sql("n_chars", "documents"))
def q_outlier_count_docs(spark, sf):
    df = _t(spark, sf, "documents")
    return _results(K.run_checks(df, [K.outliers(df, "n_chars")]))


@_query("value_counts", """
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS count FROM orders GROUP BY 2
UNION ALL
SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 2""")
def q_value_counts(spark, sf):
    return PR.value_counts(_t(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@_query("distinct_counts", _union(*[f"""
SELECT '{c}' AS "column", count({c}) AS non_null_count, count(DISTINCT {c}) AS distinct_count
FROM customer""" for c in _CUST]))
def q_distinct_counts(spark, sf):
    return PR.distinct_counts(_t(spark, sf, "customer"))


@_query("distinct_values", "SELECT DISTINCT NULLIF(o_orderstatus, 'P') AS o_orderstatus FROM orders")
def q_distinct_values(spark, sf):
    df = _t(spark, sf, "orders").select(F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"))
    return PR.distinct_values(df, "o_orderstatus")


@_query("row_count", "SELECT count(*) AS rows, CAST(6 AS BIGINT) AS columns FROM orders")
def q_row_count(spark, sf):
    return PR.row_count(_t(spark, sf, "orders"))


_CUST_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
               "c_mktsegment": "string"}


def _profile_sql(c: str) -> str:
    numeric = _CUST_TYPES[c] in ("bigint", "int", "double")
    x = f"CAST({c} AS DOUBLE)" if numeric else c
    lo_hi = f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max"
    if numeric:
        moments = (f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS stddev, "
                   f"round((SELECT avg(pow({x} - m, 3)) / pow(avg(pow({x} - m, 2)), 1.5) FROM customer, "
                   f"(SELECT avg({x}) AS m FROM customer)), 6) AS skewness, "
                   f"round(kurtosis_pop({x}), 6) AS kurtosis, round(quantile_disc({x}, 0.5), 6) AS median")
    else:
        moments = ("NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, NULL::DOUBLE AS skewness, "
                   "NULL::DOUBLE AS kurtosis, NULL::DOUBLE AS median")
    nans = f"count(*) FILTER (WHERE isnan({c}))" if _CUST_TYPES[c] == "double" else "0"
    return f"""
SELECT '{c}' AS "column", '{_CUST_TYPES[c]}' AS data_type, true AS nullable, count(*) AS rows,
       count(*) FILTER (WHERE {c} IS NULL) AS nulls, CAST({nans} AS BIGINT) AS nans,
       count(DISTINCT {c}) AS distinct, {lo_hi}, {moments}
FROM customer"""


@_query("profile", _union(*[_profile_sql(c) for c in _CUST]))
def q_profile(spark, sf):
    return _round(PR.profile(_t(spark, sf, "customer"), exact_median=True))


def _qr_sql(src: str, cols: list[str], numeric: set[str], stamps: set[str], lo: str, hi: str) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", 'null_count' AS metric,
            CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value FROM {src}""")
        if c in stamps:
            parts.append(f"""SELECT '{c}' AS "column", 'timestamp_issues' AS metric,
                CAST(count(*) FILTER (WHERE {c} IS NULL OR {c} < TIMESTAMP '{lo}'
                                      OR {c} > TIMESTAMP '{hi}') AS DOUBLE) AS value FROM {src}""")
            parts.append(f"""SELECT '{c}' AS "column", 'format_issues' AS metric,
                CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value FROM {src}""")
        if c in numeric:
            x = f"CAST({c} AS DOUBLE)"
            parts.append(f"""SELECT '{c}' AS "column", 'outlier_issues' AS metric,
                CAST(count(*) FILTER (WHERE {x} > (SELECT avg({x}) + 3.0 * stddev_samp({x}) FROM {src})
                                         OR {x} < (SELECT avg({x}) - 3.0 * stddev_samp({x}) FROM {src}))
                     AS DOUBLE) AS value FROM {src}""")
            parts.append(f"""SELECT '{c}' AS "column", 'skewness' AS metric,
                round((SELECT avg(pow({x} - m, 3)) / pow(avg(pow({x} - m, 2)), 1.5) FROM {src},
                       (SELECT avg({x}) AS m FROM {src})), 6) AS value""")
    parts.append(f"""SELECT NULL::VARCHAR AS "column", 'duplicate_count' AS metric,
        CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS DOUBLE) AS value FROM {src}""")
    return _union(*parts)


_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@_query("quality_report", _qr_sql("orders", _ORDERS_COLS, {"o_orderkey", "o_custkey", "o_totalprice"},
                                  {"o_orderdate"}, "1996-01-01 00:00:00", "2001-01-01 00:00:00"))
def q_quality_report(spark, sf):
    rep = PR.quality_report(_t(spark, sf, "orders"), ts_lo="1996-01-01 00:00:00", ts_hi="2001-01-01 00:00:00")
    return rep.withColumn("value", F.round("value", 6))


@_query("quality_report_lineitem", _qr_sql("lineitem", _LI_COLS, set(_LI_COLS[:8]), {"l_shipdate"},
                                           "1900-01-01 00:00:00", "2000-01-01 00:00:00"))
def q_quality_report_lineitem(spark, sf):
    rep = PR.quality_report(_t(spark, sf, "lineitem"), ts_hi="2000-01-01 00:00:00")
    return rep.withColumn("value", F.round("value", 6))


# ===========================================================================
# 5. cleaning

@_query("drop_nulls", f"SELECT doc_id, quality, toxic FROM {_DOC_LABELS} WHERE quality IS NOT NULL")
def q_drop_nulls(spark, sf):
    return C.drop_missing(_doc_labels(spark, sf), ["quality"]).select("doc_id", "quality", "toxic")


@_query("fill_constant", f"""
SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic, lang FROM {_DOC_LABELS}""")
def q_fill_constant(spark, sf):
    df = C.fill_constant(_doc_labels(spark, sf), {"quality": -1, "toxic": 0.7})
    return df.select("doc_id", "quality", "toxic", "lang")


@_query("fill_defaults", f"""
SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic, lang FROM {_DOC_LABELS}""")
def q_fill_defaults(spark, sf):
    return C.handle_missing(_doc_labels(spark, sf), "fill").select("doc_id", "quality", "toxic", "lang")


@_query("impute_mean", f"""
WITH s AS (SELECT CASE WHEN isnan(l_tax) THEN NULL ELSE l_tax END AS t, l_discount AS d, * EXCLUDE (l_tax, l_discount)
           FROM {_LI_NAN})
SELECT l_orderkey, l_linenumber, round(coalesce(d, (SELECT avg(d) FROM s)), 6) AS l_discount,
       round(coalesce(t, (SELECT avg(t) FROM s)), 6) AS l_tax FROM s""")
def q_impute_mean(spark, sf):
    df = C.impute_mean(_li_nan(spark, sf), ["l_discount", "l_tax"])
    return _round(df.select("l_orderkey", "l_linenumber", "l_discount", "l_tax"))


def _bounds_sql(c: str, src: str, k: float = 3.0) -> str:
    return (f"{c} BETWEEN (SELECT avg({c}) - {k} * stddev_samp({c}) FROM {src}) "
            f"AND (SELECT avg({c}) + {k} * stddev_samp({c}) FROM {src})")


@_query("remove_outliers", f"""
SELECT event_id, value, user_id FROM events
WHERE {_bounds_sql('value', 'events')} AND {_bounds_sql('CAST(user_id AS DOUBLE)', 'events')}""")
def q_remove_outliers(spark, sf):
    df = _t(spark, sf, "events").select("event_id", "value", "user_id")
    return C.remove_outliers(df, ["value", "user_id"])


_EV_DOCS = "(SELECT doc_id, CAST(n_chars AS DOUBLE) AS n, CAST(length(text) AS DOUBLE) AS w FROM documents)"


@_query("remove_outliers_sequential", f"""
WITH a AS (SELECT * FROM {_EV_DOCS} WHERE {_bounds_sql('n', _EV_DOCS)})
SELECT doc_id, n AS n_chars, w AS text_length FROM a WHERE {_bounds_sql('w', 'a')}""")
def q_remove_outliers_seq(spark, sf):
    d = _t(spark, sf, "documents")
    df = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                  F.length("text").cast("double").alias("text_length"))
    return C.remove_outliers(df, ["n_chars", "text_length"], sequential=True, drop_null=True)


# ===========================================================================
# 6. features and distributions

@_query("timestamp_parts", """
SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
       CAST(day(ts) AS INTEGER) AS ts_day, CAST(hour(ts) AS INTEGER) AS ts_hour FROM events""")
def q_timestamp_parts(spark, sf):
    return FE.timestamp_parts(_t(spark, sf, "events").select("event_id", "ts"))


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@_query("one_hot", "SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority, "
        + "CAST(NULLIF(o_orderstatus, 'P') IS NULL AS INTEGER) AS o_orderstatus_None, "
        + "CAST(coalesce(NULLIF(o_orderstatus, 'P') = 'F', false) AS INTEGER) AS o_orderstatus_F, "
        + "CAST(coalesce(NULLIF(o_orderstatus, 'P') = 'O', false) AS INTEGER) AS o_orderstatus_O, "
        + ", ".join(f"""CAST(o_orderpriority = '{p}' AS INTEGER) AS "o_orderpriority_{p.replace(' ', '_')}" """
                    for p in _PRIOS)
        + " FROM orders")
def q_one_hot(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
                                       "o_orderpriority")
    return FE.one_hot(o, ["o_orderstatus", "o_orderpriority"])


@_query("one_hot_indexed", """
SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_index,
       dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS source_index,
       dense_rank() OVER (ORDER BY text NULLS FIRST) - 1 AS text_index FROM documents""")
def q_one_hot_indexed(spark, sf):
    docs = FE.one_hot_indexed(_t(spark, sf, "documents"), ["lang", "source", "text"])
    return docs.select("doc_id", "lang_index", "source_index", "text_index")


_WIDE_CORR = [f"{c}_{k}" for k in range(4) for c in _NUM_LI]


def _wide_corr(c: str) -> str:
    """Sixteen columns of lineitem; a fourth of each has missing values by a rule of the keys."""
    name, k = c.rsplit("_", 1)
    return name if k == "0" else f"CASE WHEN (l_orderkey + l_linenumber) % {int(k) + 2} <> 0 THEN {name} * (l_linenumber + {k}) END"


@_query("correlation_matrix_wide", "WITH w AS (SELECT " + ", ".join(f"{_wide_corr(c)} AS {c}" for c in _WIDE_CORR) + " FROM lineitem) "
        + _union(*[f"SELECT '{a}' AS column_x, '{b}' AS column_y, round(corr({a}, {b}), 6) AS correlation FROM w"
                   for a in _WIDE_CORR for b in _WIDE_CORR]))
def q_correlation_wide(spark, sf):
    df = _t(spark, sf, "lineitem").selectExpr(*[f"{_wide_corr(c)} AS {c}" for c in _WIDE_CORR])
    return _round(D.correlation_matrix(df))


def _corr_sql(cols: list[str], src: str) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"""SELECT '{a}' AS column_x, '{b}' AS column_y, round(
                CASE WHEN stddev_samp({a}) * stddev_samp({b}) = 0 THEN NULL
                     ELSE covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})) END, 6) AS correlation
                FROM {src}""")
    return _union(*parts)


@_query("correlation_matrix", _corr_sql(_NUM_LI, "lineitem"))
def q_correlation(spark, sf):
    return _round(D.correlation_matrix(_t(spark, sf, "lineitem"), _NUM_LI))


_HIST_SQL = """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT CASE WHEN s.hi = s.lo THEN 1
                  ELSE least(CAST(floor((value - s.lo) / (s.hi - s.lo) * 10) AS BIGINT) + 1, 10) END AS bucket
      FROM events, s WHERE value IS NOT NULL),
c AS (SELECT bucket, count(*) AS n FROM b GROUP BY bucket)
SELECT 'value' AS "column", bucket, round(s.lo + (bucket - 1) * ((s.hi - s.lo) / 10), 6) AS lower,
       round(s.lo + bucket * ((s.hi - s.lo) / 10), 6) AS upper, coalesce(n, 0) AS count
FROM range(1, 11) g(bucket) LEFT JOIN c USING (bucket), s"""


@_query("histogram", _HIST_SQL)
def q_histogram(spark, sf):
    return _round(D.histogram(_t(spark, sf, "events"), ["value"], bins=10))


_DENSITY_SQL = """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                  stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), -0.2) AS h FROM events),
g AS (SELECT CAST(i AS INTEGER) AS point, s.lo + i * ((s.hi - s.lo) / 49) AS x FROM range(50) t(i), s)
SELECT 'value' AS "column", g.point, round(g.x, 6) AS x,
       round(sum(exp(-0.5 * ((e.value - g.x) / s.h) * ((e.value - g.x) / s.h))) * (1 / sqrt(2 * pi()))
             / (s.n * s.h), 10) AS density
FROM g, s, events e GROUP BY g.point, g.x, s.n, s.h"""


@_query("density_curve", _DENSITY_SQL)
def q_density(spark, sf):
    out = D.density_curve(_t(spark, sf, "events"), ["value"], points=50, bins=None)
    return out.select("column", "point", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))


@_query("density_curve_binned", f"""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n, (max(value) - min(value)) / {D.DENSITY_BINS - 1} AS w,
                  stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), -0.2) AS h FROM events),
u AS (SELECT (value - lo) / w AS u, least(floor((value - lo) / w), {D.DENSITY_BINS - 2}) AS bin FROM events, s WHERE value IS NOT NULL),
b AS (SELECT bin, count(*) AS n, sum(u - bin) AS part FROM u GROUP BY bin),
p AS (SELECT place, sum(weight) AS weight FROM (SELECT bin AS place, n - part AS weight FROM b
                                                UNION ALL SELECT bin + 1, part FROM b) GROUP BY place),
g AS (SELECT CAST(i AS INTEGER) AS point, s.lo + i * ((s.hi - s.lo) / 49) AS x FROM range(50) t(i), s)
SELECT 'value' AS "column", g.point, round(g.x, 6) AS x,
       round(sum(p.weight * exp(-0.5 * ((s.lo + place * s.w - g.x) / s.h) * ((s.lo + place * s.w - g.x) / s.h)))
             / (sqrt(2 * pi()) * s.n * s.h), 10) AS density
FROM g, s, p GROUP BY g.point, g.x, s.n, s.h""")
def q_density_binned(spark, sf):
    out = D.density_curve(_t(spark, sf, "events"), ["value"], points=50)
    return out.select("column", "point", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))


@_query("box_stats", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
                  quantile_cont(value, 0.75) AS q3 FROM events),
f AS (SELECT q1, q2, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT 'value' AS "column", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (WHERE value >= lo), 6) AS lower_whisker,
       round(max(value) FILTER (WHERE value <= hi), 6) AS upper_whisker,
       count(*) FILTER (WHERE value < lo OR value > hi) AS outliers
FROM events, f GROUP BY q1, q2, q3""")
def q_box(spark, sf):
    return _round(D.box_stats(_t(spark, sf, "events"), ["value"]))


@_query("one_hot_long", """
SELECT p_partkey, 'p_brand' AS "column", p_brand AS value FROM part
UNION ALL SELECT p_partkey, 'p_type', p_type FROM part""")
def q_one_hot_long(spark, sf):
    return FE.one_hot_long(_t(spark, sf, "part"), ["p_partkey"], ["p_brand", "p_type"])


@_query("allowed_values_empty", _pred_row_sql("allowed_values", "status", "invalid_count", "true",
        "Column status has values outside the allowed set", "orders"))
def q_allowed_empty(spark, sf):
    orders = _t(spark, sf, "orders").select(F.expr("nullif(o_orderstatus, 'P')").alias("status"))
    return _results(K.run_checks(orders, [K.allowed_values(orders, "status", [])]))


# ===========================================================================
# 7. results and alerts

@_query("alerts", "SELECT 'ETL Process Error' AS title, message AS text FROM (__SUITE__) WHERE status = 'fail'")
def q_alerts(spark, sf):
    return RS.alerts(_suite(spark, sf))


@_query("log_rows", "SELECT CASE WHEN status = 'fail' THEN 'ERROR' ELSE 'INFO' END AS level, message "
        "FROM (__SUITE__)")
def q_log_rows(spark, sf):
    return RS.log_rows(_suite(spark, sf))


for _k in ("alerts", "log_rows"):
    _SQL[_k] = _SQL[_k].replace("__SUITE__", _SQL["check_suite"])


# ===========================================================================
# queries of the optional llm subpackage, where it is present

try:
    from tablewatch.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("tablewatch.llm", "tablewatch.llm.queries", "corpus_pipeline"):
        raise
else:
    _QUERIES.update(_llm.QUERIES)
    _SQL.update(_llm.SQL)


# ===========================================================================
# driver contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship pipeline on the sf0.001 fixtures."""
    return flagship_pipeline(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
