"""Exact top-k search by inner product: ball trees over shards, branch and bound with a shared kth score.

Space is cut in cells by a tree of median cuts, fitted on a bounded sample; each cell is a region with a centre and a radius. A
cell with more than SHARD_ROWS candidates is dealt by hash to several shards, so that the driver holds MAX_CELLS centres at most,
whatever the table. A query visits cells in the order of their bounds q.c + |q| r, in WAVES: after each wave its kth score so far is
shared, and only cells, and inside shards only tree nodes, whose bound reaches it are searched, in the order of their bounds.

Results for special cases: see `vectors.usable` for rows that take no part; rows that share an id are candidates each, and a row is no
candidate of its own; fewer candidates than k give all of them; ties go to the smaller id; copies of a vector beyond k + 1 can't
enter a list and are not searched; no queries or no candidates give an empty result; other columns are not read. Scores are
exact integers; components and scores beyond a long's range count as its nearest end.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import materialise

#: Candidates in a shard, about; cells at most; sampled rows for each cell.
SHARD_ROWS, MAX_CELLS, SAMPLE_ROWS = 32_768, 1024, 16
#: A wave ends before the cell of this rank in a query's own order.
WAVES = (1, 4, None)
LEAF = 128
_ENDS = (-(1 << 63), (1 << 63) - 1)


def quantise(vec: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as a long; what lies beyond becomes the nearest end."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale))


def _halve(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """A cut of `rows` at the median along the line between two far points: direction, threshold, mask of the upper half."""
    own = points[rows]
    a = own[np.argmax(((own - own[0]) ** 2).sum(axis=1))]
    b = own[np.argmax(((own - a) ** 2).sum(axis=1))]
    direction = a - b
    along = own @ direction
    threshold = float(np.median(along))
    upper = along > threshold
    if not upper.any():  # half of the points share the largest value
        upper = along >= threshold
    return direction, threshold, upper


class Cells:
    """A tree of median cuts with about `n` leaves."""

    def __init__(self, sample: np.ndarray, n: int):
        self.cuts: list[tuple] = []
        self.leaves = 0
        self.root = self._grow(sample, np.arange(len(sample)), n)

    def _grow(self, sample, rows, n):
        if n > 1 and len(rows) > 1:
            direction, threshold, upper = _halve(sample, rows)
            if not upper.all():
                at = len(self.cuts)
                self.cuts.append(None)
                self.cuts[at] = (direction, threshold, self._grow(sample, rows[~upper], n // 2), self._grow(sample, rows[upper], n - n // 2))
                return at
        self.leaves += 1
        return -self.leaves

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                direction, threshold, low, high = self.cuts[node]
                upper = points[rows] @ direction > threshold
                todo += [(low, rows[~upper]), (high, rows[upper])]
        return out


class BallTree:
    """Nodes with centre and radius over one shard; leaves hold at most LEAF rows (or copies of one point)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.exact = ids[order], points[order]
        self.points = self.exact.astype(np.float64)
        self.largest = _largest(self.exact)
        self.rows: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(np.arange(len(ids)), None)]
        while todo:
            rows, parent = todo.pop()
            at = len(self.rows)
            own = self.points[rows]
            centre = own.mean(axis=0)
            centres.append(centre)
            radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
            if parent is not None:
                self.children[parent] = (*(self.children[parent] or ()), at)
            split = None
            if len(rows) > LEAF and radii[-1] > 0:
                upper = _halve(self.points, rows)[2]
                split = None if upper.all() else upper
            self.rows.append(rows if split is None else None)
            self.children.append(None)
            if split is not None:
                todo += [(rows[~split], at), (rows[split], at)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.reach = np.sqrt((self.centres**2).sum(axis=1)) + self.radii

    def bounds(self, query: np.ndarray) -> np.ndarray:
        length = np.sqrt(query @ query)
        own = self.centres @ query + length * self.radii
        return np.clip(own + 1e-9 * (1 + length * self.reach), *map(float, _ENDS))

    def hits(self, query: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The `k` best (scores, ids, whether the vector is the query's); nothing below `floor` is looked for."""
        exact = _largest(query) * self.largest * len(query) < 2**53
        wide = query.astype(np.float64 if exact else object)
        bounds = self.bounds(query.astype(np.float64))
        scores, rows = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = -np.inf if floor is None else floor
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.rows[node] is None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            held = self.rows[node]
            own = self.points[held] @ wide if exact else np.clip(self.exact[held].astype(object) @ wide, *_ENDS)
            good = np.flatnonzero(own >= least)
            if not len(good):
                continue
            scores = np.concatenate([scores, own[good].astype(np.int64)])
            rows = np.concatenate([rows, held[good]])
            if len(scores) > k:
                keep = np.lexsort((self.ids[rows], ~scores))[:k]  # ~s falls as s grows, at both ends of a long too
                scores, rows = scores[keep], rows[keep]
            if len(scores) == k:
                least = max(least, int(scores.min()))
        return scores, self.ids[rows], (self.exact[rows] == query).all(axis=1)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


class _Searcher:
    def __init__(self, k: int):
        self.k = k

    def __call__(self, ids: np.ndarray, points: np.ndarray):
        tree = BallTree(ids, points.astype(np.int64))
        return _Bound(tree, self.k)


class _Bound:
    def __init__(self, tree: BallTree, k: int):
        self.tree, self.k = tree, k

    def hits(self, query: np.ndarray, floor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if floor is not None:  # a floor that came as a double may be rounded up
            floor = int(floor if abs(floor) < 2**53 or not isinstance(floor, float) else np.nextafter(floor, -np.inf))
        return self.tree.hits(query.astype(np.int64), self.k, floor)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, max_cells: int = MAX_CELLS, waves: tuple = WAVES) -> DataFrame:
    """(query_id, rank, vec_id, score long) of integer vectors (id long, vec array<long>); a query's own row is no candidate of its.

    SAMPLE_ROWS rows for each cell are sampled to cut the space; all rows are searched.
    """
    spark = candidates.sparkSession
    kept = materialise(vectors.thin_copies(candidates, k + 1))
    asked = vectors.distinct_queries(queries)
    n = kept.count()
    n_cells = min(max(-(-n // shard_rows), min(2 * spark.sparkContext.defaultParallelism, -(-n // 2048)), 1), max_cells)
    sample = kept.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS * n_cells).select("vec").collect()  # bounded by max_cells
    if not sample or asked.isEmpty():
        return vectors.answers(queries, asked, spark.createDataFrame([], vectors.BEST.format("long")), k)
    drawn = np.array([r["vec"] for r in sample], float)
    cells = Cells(drawn, n_cells)
    of = cells.of(drawn)
    centres = np.array([drawn[of == c].mean(axis=0) for c in range(cells.leaves)])

    @F.pandas_udf("cell long, away double")
    def locate(vec: pd.Series) -> pd.DataFrame:
        points = np.array(vec.tolist(), np.float64).reshape(len(vec), -1)
        cell = cells.of(points) if len(vec) else np.zeros(0, np.int64)
        return pd.DataFrame({"cell": cell, "away": np.sqrt(((points - centres[cell]) ** 2).sum(axis=1)) if len(vec) else np.zeros(0)})

    placed = materialise(kept.withColumn("_at", locate("vec")).select("id", "vec", "_at.cell", "_at.away"))
    balls = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()  # a row a cell
    numbers, radii = np.array([r["cell"] for r in balls]), np.array([r["radius"] for r in balls])
    centres_used = centres[numbers]
    reach = np.sqrt((centres_used**2).sum(axis=1)) + radii
    first, sizes = 0, []
    for r in balls:
        sizes.append((r["cell"], first, -(-r["n"] // shard_rows)))
        first += sizes[-1][2]
    shards = F.broadcast(spark.createDataFrame(sizes, "cell long, _first long, _shards long"))
    held = placed.join(shards, "cell").select((F.col("_first") + F.pmod(F.xxhash64("id", "vec"), F.col("_shards"))).alias("shard"), "id", "vec")

    def route(pdf: pd.DataFrame, lo: int, hi: int) -> pd.DataFrame:
        points = np.array(pdf["vec"].tolist(), np.float64)
        length = np.sqrt((points**2).sum(axis=1))[:, None]
        bounds = np.clip(points @ centres_used.T + length * radii + 1e-9 * (1 + length * reach), *map(float, _ENDS))
        order = np.argsort(-bounds, axis=1, kind="stable")[:, lo:hi]
        wanted = np.take_along_axis(bounds, order, axis=1) >= pdf["floor"].fillna(-np.inf).to_numpy(float)[:, None]
        row, col = np.nonzero(wanted)
        out = pdf.iloc[row][["qid", "vec", "floor"]].reset_index(drop=True)
        out["cell"] = numbers[order[row, col]]
        return out

    found = spark.createDataFrame([], vectors.BEST.format("long"))
    lo = 0
    for end in waves:
        hi = len(numbers) if end is None else min(end, len(numbers))
        if lo >= hi:
            continue
        floors = found.filter(F.size("hits") > k).select("qid", F.array_min(F.transform("hits", lambda h: h["score"])).alias("floor"))
        known = asked.join(floors, "qid", "left") if lo else asked.withColumn("floor", F.lit(None).cast("long"))
        routed = known.select("qid", "vec", "floor").mapInPandas(lambda it, lo=lo, hi=hi: (route(x, lo, hi) for x in it if len(x)), "qid long, vec array<long>, floor long, cell long")
        each = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_shards") - 1))
        sent = routed.join(shards, "cell").select(each.alias("shard"), "qid", "vec", "floor")
        hits = vectors.search_shards(held, sent, _Searcher(k + 1), "long")
        earlier = found.select("qid", F.transform("hits", lambda h: F.struct(h["score"].alias("score"), h["id"].alias("id"), h["same"].alias("same"))).alias("hits"))
        found = materialise(vectors.best(hits.unionByName(earlier) if lo else hits, k + 1))
        lo = hi
    return vectors.answers(queries, asked, found, k)


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """`top_k` over components floor(scale * x): rows for which `is_query` (of column id) holds ask, all rows are candidates."""
    rows = materialise(vectors.usable(df, id_col, vec_col).select("id", quantise(F.col("vec"), scale).alias("vec")))
    return vectors.by_length(rows, lambda own: top_k(own, own.filter(is_query), k))
