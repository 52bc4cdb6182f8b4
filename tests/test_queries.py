"""Every query against its SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from cohortspan.plans import all_queries, entry_query

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item"):
        return norm(v.item())
    return round(float(v), 6) + 0.0 if isinstance(v, int | float) and not isinstance(v, bool) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    a = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(a)
        return
    b = duck.execute(ORACLES[name]).fetchdf()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted((tuple(map(norm, r)) for r in a[cols].itertuples(index=False)), key=repr) == sorted((tuple(map(norm, r)) for r in b[cols].itertuples(index=False)), key=repr)


def test_entry(spark):
    assert entry_query(spark, SF).count() == 6


def test_whole_sequences(spark):
    """By brute force over the whole texts, of which many are longer than any prefix."""
    from cohortspan.plans.registry import Tables

    seqs = {r.contig: r.seq for r in Tables(spark, SF).sequences.select("contig", "seq").collect()}
    assert max(map(len, seqs.values())) > 2000
    sets = {c: {s[i : i + 7] for i in range(len(s) - 6) if set(s[i : i + 7]) <= set("ACGT")} for c, s in seqs.items()}
    assert {r.name: r.kmers for r in QUERIES["scl_32_distinct_kmers_whole"](spark, SF).collect()} == {c: len(k) for c, k in sets.items() if k}
    assert {r.contig: len(r.seq) for r in QUERIES["scl_16_mask_bases_whole"](spark, SF).collect()} == {c: len(s) for c, s in seqs.items()}
