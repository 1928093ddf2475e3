"""Every query of the subpackage that has SQL, against DuckDB on whole tables."""
import os

import duckdb
import pytest

import __spark_entry__
from tablewatch.llm import queries


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in queries.QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}
    assert queries.SQL.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf_small, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_small, table)}.parquet'")
    got = queries.QUERIES[name](spark, sf_small)
    columns = sorted(got.columns)
    want = con.sql(queries.SQL[name])
    assert sorted(want.columns) == columns
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=str)
    assert rows == sorted(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall(), key=str)
