"""Registered queries against their SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from cohortspan.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(set(queries.oracle_sql()) - {"op1_ball_tree"}))
def test_query(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    found = queries.queries()[name](spark, SF)
    rel = con.sql(queries.oracle_sql()[name])
    assert sorted(found.columns) == sorted(rel.columns)
    expected = rel.project(", ".join(found.columns)).fetchall()
    assert len(expected) > 20 and sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
