"""What both vector searches share: usable vectors, distinct queries, shards searched by a stream of queries, and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions

HIT = "hits array<struct<score:{0},id:long,same:boolean>>"
BEST = "qid long, hits array<struct<nth:int,id:long,score:{0},same:boolean>>"
#: Queries that one task answers from one shard, about.
QUERY_ROWS = 100_000


def usable(df: DataFrame, id_col: str, vec_col: str, nonzero: bool = False) -> DataFrame:
    """(id long, vec array<double>) of the rows that take part; rows that share an id each take part.

    Left out: null ids, vectors that are null, empty, or hold null or non-finite components (or only zeros with `nonzero`).
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).filter(F.forall("vec", finite))
    return rows.filter(F.exists("vec", lambda x: x != 0)) if nonzero else rows


def by_length(rows: DataFrame, search: Callable[[DataFrame], DataFrame], most: int = 16) -> DataFrame:
    """`search` of the vectors of each length by themselves: nothing measures vectors of two lengths against each other.

    A table has one length, or a few; more than `most` are an error, not left out.
    """
    lengths = sorted(r["n"] for r in rows.select(F.size("vec").alias("n")).distinct().limit(most + 1).collect())
    if len(lengths) > most:
        raise ValueError(f"vectors of more than {most} lengths")
    found = [search(rows.filter(F.size("vec") == n) if len(lengths) > 1 else rows) for n in lengths or [0]]
    return reduce(DataFrame.union, found)


def thin_copies(rows: DataFrame, copies: int) -> DataFrame:
    """At most `copies` rows of each vector, those with the smallest ids: no other copy can enter a list of that length."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    return rows.withColumn("_nth", nth).filter(F.col("_nth") <= copies).drop("_nth")


def distinct_queries(queries: DataFrame) -> DataFrame:
    """One row (qid, vec) for each vector that is asked for, numbered."""
    return materialise(queries.select("vec").distinct()).select(F.monotonically_increasing_id().alias("qid"), "vec")


def deal(held: DataFrame, sent: DataFrame) -> DataFrame:
    """(shard, slice, side, the other columns) of both tables, each shard with its queries behind it (side 1).

    Both have shard, id and the same other columns. A shard that many queries ask goes to several tasks, each with its share of
    them; one that none asks goes nowhere.
    """
    need = sent.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("slices"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    rest = [c for c in held.columns if c != "shard"]
    a = held.join(need, "shard").select("shard", each.alias("slice"), F.lit(0).alias("side"), *rest)
    b = sent.join(need, "shard").select("shard", F.pmod(F.xxhash64("id"), F.col("slices")).alias("slice"), F.lit(1).alias("side"), *rest)
    return a.union(b).repartition(shuffle_partitions(held.sparkSession), "shard", "slice").sortWithinPartitions("shard", "slice", "side")


def search_shards(held: DataFrame, sent: DataFrame, build: Callable, score: str) -> DataFrame:
    """(qid, hits) of each query of `sent` (shard, qid, vec, floor) in its shard of `held` (shard, id, vec).

    `build(ids, points)` makes a shard searchable; its `hits(query, floor)` gives (scores, ids, same), best first. A task holds one
    shard's candidates and reads queries as a stream.
    """
    asked = sent.select("shard", F.col("qid").alias("id"), "vec", F.col("floor").cast(score).alias("floor"))
    both = deal(held.select("shard", "id", "vec", F.lit(None).cast(score).alias("floor")), asked)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, points, built = None, [], [], None
        for batch in batches:
            keys = batch[["shard", "slice", "side"]].to_numpy()
            edges = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for lo, hi in zip([0, *edges], [*edges, len(keys)], strict=True):
                if lo == hi:
                    continue
                part, own = batch.iloc[lo:hi], tuple(keys[lo, :2])
                if own != key:
                    key, ids, points, built = own, [], [], None
                vecs = np.array(part["vec"].tolist())
                if keys[lo, 2] == 0:
                    ids.append(part["id"].to_numpy(np.int64))
                    points.append(vecs)
                elif ids or built:
                    if not built:
                        built = build(np.concatenate(ids), np.concatenate(points))
                        ids, points = [], []
                    found = [built.hits(q, None if pd.isna(f) else f) for q, f in zip(vecs, part["floor"], strict=True)]
                    hits = [[{"score": s.item(), "id": int(i), "same": bool(e)} for s, i, e in zip(*x, strict=True)] for x in found]
                    yield pd.DataFrame({"qid": part["id"].to_numpy(np.int64), "hits": hits})

    return both.mapInPandas(run, "qid long, " + HIT.format(score))


def best(hits: DataFrame, k: int) -> DataFrame:
    """(qid, hits): the `k` best of all shards' hits, ties to the smaller id. A query has `k` hits from each shard at most."""
    flat = hits.select("qid", F.explode("hits").alias("h"))
    nth = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("h.score"), F.asc("h.id")))
    top = flat.withColumn("nth", nth).filter(F.col("nth") <= k)
    one = F.struct("nth", F.col("h.id").alias("id"), F.col("h.score").alias("score"), F.col("h.same").alias("same"))
    return top.groupBy("qid").agg(F.array_sort(F.collect_list(one)).alias("hits"))


def answers(queries: DataFrame, asked: DataFrame, found: DataFrame, k: int, id_name: str = "vec_id") -> DataFrame:
    """(query_id, rank, `id_name`, score): for every asking row the first `k` hits without the row itself.

    Rows that ask for the same vector share its hits; the join that deals them out has one row a vector on its other side, so a hot
    vector's rows can be split.
    """
    by_vec = asked.join(found, "qid").select("vec", "hits")
    own = queries.join(by_vec, "vec")
    itself = F.array_position(F.transform("hits", lambda h: (h["id"] == F.col("id")) & h["same"]), True)
    rest = F.slice(F.filter("hits", lambda h, i: i + 1 != F.col("_own")), 1, k)
    placed = own.withColumn("_own", itself).select(F.col("id").alias("query_id"), F.posexplode(rest).alias("rank", "h"))
    return placed.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("h.id").alias(id_name), F.col("h.score").alias("score"))
