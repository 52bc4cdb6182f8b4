"""Both vector searches against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspan.llm import ball_tree, learned_partitions, queries, vectors


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 12)).astype(np.float32)
    x[200:500] = x[200]  # a third are copies
    data = [(i, v.tolist(), "q") for i, v in enumerate(x)]
    data += [(2000, None, ""), (2001, [float("nan")] * 12, ""), (2002, [1.0] * 5, ""), (2003, [None] * 12, ""), (None, [1.0] * 12, ""), (2004, [0.0] * 12, ""), (2005, [float("inf")] * 12, ""), (3, x[3].tolist(), "again")]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, qid string"), x


def plain_top(ids, z, asking, k):
    """Rows (query, rank, id, score) by all pairs of rows; a row leaves only itself out."""
    out = []
    for i in np.flatnonzero(asking):
        s = z @ z[i]
        out += [(ids[i], r + 1, ids[j], s[j]) for r, j in enumerate([j for j in np.lexsort((ids, -s)) if j != i][:k])]
    return sorted(out)


def test_exact(table):
    """Rows that share an id count each: id 3 twice with one vector, id 40 twice with two."""
    df, x = table
    df = df.union(df.sparkSession.createDataFrame([(40, x[41].tolist(), "again")], df.schema))
    z = np.vstack([np.floor(64 * x.astype(float)), np.zeros(12), np.floor(64 * x[[3, 41]].astype(float))]).astype(np.int64)
    ids = np.array([*range(900), 2004, 3, 40])
    got = ball_tree.search(df, F.col("id") % 20 == 0, k=20)
    assert sorted(map(tuple, got.collect())) == plain_top(ids, z, ids % 20 == 0, 20)


@pytest.mark.parametrize("max_cells", [1, 3, 1024])
def test_exact_with_many_shards_and_slices(table, monkeypatch, max_cells):
    monkeypatch.setattr(vectors, "QUERY_ROWS", 5)
    df, _ = table
    rows = df.filter("vec_id < 900 and qid = 'q'").select(F.col("vec_id").alias("id"), ball_tree.quantise(F.col("embedding")).alias("vec"))
    one = ball_tree.top_k(rows, rows.filter("id % 50 = 0"), 5, shard_rows=2000, waves=(None,))
    many = ball_tree.top_k(rows, rows.filter("id % 50 = 0"), 5, shard_rows=90, max_cells=max_cells)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_components_and_scores_beyond_a_long(spark):
    """Finite components that leave a long's range count as its end, and so do scores; ties then go by id."""
    x = [[1e30, 1.0], [-1e30, 2.0], [3.0, 4.0], [1e30, -1e30], [0.5, 0.25], [1e17, 0.0]]
    ends = -(1 << 63), (1 << 63) - 1
    z = [[min(max(int(np.floor(64 * c)), ends[0]), ends[1]) for c in v] for v in x]
    got = ball_tree.search(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>"), F.lit(True), k=4)
    want = []
    for i, q in enumerate(z):
        s = [(-min(max(sum(a * b for a, b in zip(q, v)), ends[0]), ends[1]), j) for j, v in enumerate(z) if j != i]
        want += [(i, r + 1, j, -n) for r, (n, j) in enumerate(sorted(s)[:4])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_large_components_stay_exact(spark):
    big = 1 << 28
    rows = spark.createDataFrame([(i, [big + i, big - i]) for i in range(30)], "id long, vec array<long>")
    got = ball_tree.top_k(rows, rows.filter("id = 7"), 3).orderBy("rank").collect()
    want = sorted(((-((big + 7) * (big + i) + (big - 7) * (big - i)), i) for i in range(30) if i != 7))[:3]
    assert [(-r.score, r.vec_id) for r in got] == want


def test_approximate(table):
    df, x = table
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    got = {}
    for r in learned_partitions.search(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = 0
    for q, found in got.items():
        s = unit @ unit[q]
        want = [j for j in np.lexsort((np.arange(900), -np.round(s, 12))) if j != q][:5]
        hit += len({v for v, _ in found} & set(want))
        assert all(abs(s[v] - c) < 1e-12 for v, c in found) and len(found) == 5
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert set(got) == set(range(0, 900, 50)) and hit / (5 * len(got)) >= 0.9


def test_two_levels_of_parts(spark, monkeypatch):
    """Vectors around centres: both levels are learned, and the probes measured on the table reach the recall."""
    monkeypatch.setattr(learned_partitions, "MAX_PARTS", 8)
    monkeypatch.setattr(learned_partitions, "ROWS_A_PART", 64)
    monkeypatch.setattr(learned_partitions, "PART_ROWS", 50)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))[rng.integers(0, 60, 3000)] + 0.2 * rng.normal(size=(3000, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    kept = rows.cache()
    parts = learned_partitions._learn(kept, 3000, 512)
    assert parts.parts == 8 and parts.below == 8 and len(parts.inner) == 8
    got = learned_partitions.nearest(rows, rows.filter("id % 50 = 0"), 5, recall=0.95, sample_rows=512).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(q, j) for q in range(0, 3000, 50) for j in [j for j in np.argsort(-(unit @ unit[q]), kind="stable") if j != q][:5]}
    assert len(got) == 300 and len(want & {(r.query_id, r.vec_id) for r in got}) / 300 >= 0.9


def test_queries_reach_a_group_of_parts_once(spark, monkeypatch):
    """However many parts are probed, a query is one row for each group of them; a group's lists are those of all its probed rows."""
    monkeypatch.setattr(learned_partitions, "MAX_PARTS", 8)
    monkeypatch.setattr(learned_partitions, "ROWS_A_PART", 64)
    found, best = [], vectors.best
    monkeypatch.setattr(vectors, "best", lambda hits, k: best(found.append(hits) or hits, k))
    x = np.random.default_rng(8).normal(size=(3000, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    got = learned_partitions.nearest(rows, rows.filter("id % 50 = 0"), 5, recall=1.0, sample_rows=512).collect()
    assert len(got) == 300 and 60 <= found[0].count() <= 2 * 60


@pytest.mark.parametrize("cells", [40, 1 << 20])
def test_group_of_parts(monkeypatch, cells):
    """Blocks of queries that probe different parts, with copies and scaled copies, against each query by itself."""
    monkeypatch.setattr(learned_partitions, "CELLS", cells)
    rng = np.random.default_rng(9)
    x, part = rng.integers(-3, 4, (200, 4)).astype(float) + 0.5, rng.integers(0, 9, 200)
    x[50:80] = x[50] * rng.choice([1, 2, 4], 30)[:, None]
    ids, query = rng.permutation(200), np.vstack([x[50:60], rng.normal(size=(30, 4))])
    probes = [rng.choice(12, rng.integers(0, 8), replace=False) for _ in query]
    got = learned_partitions._Group(ids, x, part, 6).hits(query, np.repeat(np.arange(len(query)), [len(p) for p in probes]), np.concatenate(probes))
    want = []
    for i, (q, p) in enumerate(zip(query, probes, strict=True)):
        own = np.flatnonzero(np.isin(part, p))
        score = learned_partitions.cosine(q, x[own])
        want += [(i, score[j], ids[own[j]], (x[own[j]] == q).all()) for j in np.lexsort((ids[own], -score))[:6]]
    assert list(zip(*got, strict=True)) == want


@pytest.mark.parametrize("size", [1e200, 1e-200, 5e-324, 1.7e308])
def test_cosines_of_extreme_vectors(spark, size):
    rng = np.random.default_rng(6)
    x = rng.integers(-4, 5, (60, 6)).astype(float)
    x[:, 0] = 1
    scaled = [(v * min(size, 4e307) if size > 1 else v * size).tolist() if i % 2 else v.tolist() for i, v in enumerate(x)]
    df = spark.createDataFrame(list(enumerate(scaled)), "vec_id long, embedding array<double>")
    got = learned_partitions.search(df, F.col("id") % 2 == 1, recall=1.0).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert len(got) == 5 * 30 and all(abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12 for r in got)
    assert all(r.score >= np.sort(np.delete(unit @ unit[r.query_id], r.query_id))[-5] - 1e-12 for r in got)


def test_vectors_of_several_lengths(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 5)][: 2 + i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for search, k in ((ball_tree.search, 20), (learned_partitions.search, 5)):
        got = search(df, F.col("id") % 10 < 2, k=k).collect()
        assert all(r.query_id % 2 == r.vec_id % 2 for r in got) and {r.query_id for r in got} == {i for i in range(60) if i % 10 < 2}
        assert len(got) == 12 * k
    many = spark.createDataFrame([(i, [1.0] * (1 + i)) for i in range(20)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="lengths"):
        ball_tree.search(many, F.col("id") == 1)


def test_empty(table):
    df, _ = table
    for search in (ball_tree.search, learned_partitions.search):
        assert search(df.limit(0), F.col("id") == 0).count() == 0
        assert search(df, F.lit(False)).count() == 0
        assert search(df.filter("vec_id = 1"), F.col("id") == 1).count() == 0


def test_exact_query_equals_its_sql(table, tmp_path, spark):
    """On all kinds of rows, those that take no part and repeated ones among them."""
    df, _ = table
    df.union(spark.createDataFrame([(40, [0.25] * 12, "again"), (60, [], "")], df.schema)).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    sql = con.execute(queries.oracle_sql()["op1_ball_tree"])
    columns, want = [c[0] for c in sql.description], sql.fetchall()
    got = queries.op1_ball_tree(spark, str(tmp_path))
    assert got.columns == columns and sorted(map(tuple, got.collect())) == sorted(want) and want
