"""The registered queries against their DuckDB oracle SQL on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from scripts.oracle_check import norm  # noqa: E402
from tablewatch.sources.files import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    # queries of the optional subpackage have SQL only where SQL can express them
    own = {name for name, query in E.queries().items() if query.__module__ == E.__name__}
    assert len(own) > 60 and own <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["c_nationkey", "o_totalprice_avg", "o_totalprice_double_avg"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    scols = sdf.columns
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    s = sorted(tuple(norm(r[i]) for i in order) for r in sdf.collect())
    d = sorted(tuple(norm(r[i]) for i in dorder) for r in cur.fetchall())
    assert s == d
