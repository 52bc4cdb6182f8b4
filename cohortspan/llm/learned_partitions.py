"""Approximate nearest neighbours by learned partitions.

On a sample of at most SAMPLE vectors the neighbour graph is cut into balanced parts (recursive bisection at the median of
the graph's slow eigenvector), and a small network learns to tell from a vector in which parts its neighbours lie. A larger
table has two levels: each part is cut again on a sample of its own, by a network of its own, so that parts stay small up to
64 x 64 of them. Every vector of the table is indexed in its most probable part; neighbouring parts make a group for one task, and a part
beyond PART_ROWS is dealt to several. A query probes its most probable parts by the product of both levels: it is sent once to each group that
has some of them, with their numbers, and all vectors of these parts are reranked by exact cosine.

How many parts are probed is measured, not assumed: for CALIBRATION of the asked vectors the exact neighbours in the whole
table are found, and the fewest probes that reach them with the wanted recall are taken.

Results for special cases: see `vectors.usable` for rows that take no part (zero vectors too); rows that share an id are candidates
each, and a row is no candidate of its own; fewer candidates than k give all of those probed; ties go to the smaller id; copies of
a vector beyond k + 1 can't enter a list and are not searched; no queries or no candidates give an empty result; other
columns are not read.
"""

from __future__ import annotations

import logging
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors
from .common import materialise

log = logging.getLogger(__name__)
SAMPLE, CALIBRATION = 4096, 256
#: Rows of the table for each part, about; parts that one network tells apart, at most; candidates of one task, about.
ROWS_A_PART, MAX_PARTS, PART_ROWS = 512, 64, 32_768
#: Tasks that candidates are dealt to, rows of one at least, and the numbers in their vectors at most.
GROUPS, GROUP_ROWS, GROUP_NUMBERS = 32, 2048, 1 << 22
#: Queries that meet a group at once, queries routed at once, and cosines held at once.
BLOCK, ROUTED, CELLS = 1024, 256, 1 << 20


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row of normalised `x`."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for at in range(0, len(x), 512):
        near = x[at : at + 512] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 512] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] else 0
    return out


def bisect(near: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 60) -> np.ndarray:
    """Balanced parts (a power of two) of the graph with edges row - near[row]."""
    label = np.zeros(len(near), np.int64)
    src = np.repeat(np.arange(len(near)), near.shape[1])
    dst = near.ravel()
    for _ in range(parts.bit_length() - 1):
        inside = label[src] == label[dst]
        a, b = src[inside], dst[inside]
        degree = np.bincount(a, minlength=len(near)) + np.bincount(b, minlength=len(near)) + 1.0
        value = rng.normal(size=len(near))
        size = np.maximum(np.bincount(label), 1)
        for _ in range(rounds):
            value -= (np.bincount(label, value) / size)[label]
            value = (value + np.bincount(a, value[b], len(near)) + np.bincount(b, value[a], len(near))) / degree
            value /= np.sqrt(np.bincount(label, value**2) / size + 1e-30)[label]
        order = np.lexsort((value, label))
        rank = np.empty(len(near), np.int64)
        rank[order] = np.arange(len(near))
        first = np.cumsum(np.bincount(label)) - np.bincount(label)
        label = 2 * label + (2 * (rank - first[label]) >= np.bincount(label)[label])
    return label


class Router:
    """One hidden layer, softmax over the parts; learned by Adam on minibatches."""

    def __init__(self, x: np.ndarray, target: np.ndarray, rng: np.random.Generator, hidden: int = 128, epochs: int = 40, rate: float = 3e-3):
        d, p = x.shape[1], target.shape[1]
        self.w = [rng.normal(0, np.sqrt(2 / d), (d, hidden)) * np.sqrt(d), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, p)), np.zeros(p)]
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for epoch in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(len(x) // 128, 1)):
                own = x[rows]
                h = np.maximum(own @ self.w[0] + self.w[1], 0)
                back = (self._softmax(h @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
                inner = back @ self.w[2].T * (h > 0)
                t += 1
                for i, g in enumerate((own.T @ inner, inner.sum(axis=0), h.T @ back, back.sum(axis=0))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g**2
                    self.w[i] = self.w[i] - rate * (1 - epoch / epochs) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def logs(self, x: np.ndarray) -> np.ndarray:
        """The logarithm of each part's probability."""
        z = np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def fit(x: np.ndarray, parts: int, seed: int = 11) -> Router:
    """The router of `parts` parts (a power of two) of a sample of normalised vectors."""
    rng = np.random.default_rng(seed)
    near = neighbours(x, 10)
    label = bisect(near, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), label[near].ravel()), 1.0)
    target[np.arange(len(x)), label] += 1
    return Router(x, target / target.sum(axis=1, keepdims=True), rng)


class Parts:
    """One router, and below it one for each of its parts, each of which makes `below` parts."""

    def __init__(self, top: Router, parts: int, below: int = 1, inner: dict[int, Router] | None = None):
        self.top, self.parts, self.below, self.inner = top, parts, below, inner or {}

    def home(self, x: np.ndarray) -> np.ndarray:
        """The part in which each vector is indexed: the most probable one, level by level."""
        outer = self.top.logs(x).argmax(axis=1)
        out = outer * self.below
        for p, router in self.inner.items():
            own = np.flatnonzero(outer == p)
            if len(own):
                out[own] += router.logs(x[own]).argmax(axis=1)
        return out

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """All parts by falling probability."""
        logs = np.repeat(self.top.logs(x), self.below, axis=1)
        for p, router in self.inner.items():
            logs[:, p * self.below : (p + 1) * self.below] += router.logs(x)
        return np.argsort(-logs, axis=1, kind="stable")


def _unit(vec: pd.Series) -> np.ndarray:
    x = np.array(vec.tolist(), np.float64)
    return _normal(x)


def _normal(x: np.ndarray) -> np.ndarray:
    x = _level(x)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def _level(x: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two, so that its largest component is from a half to one: no bit is lost, and squares stay in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision. Each row is summed alike, so equal vectors get equal scores wherever they stand."""
    query, rows = _level(query), _level(rows)
    return (rows * query).sum(axis=1) / (np.sqrt((rows**2).sum(axis=1)) * np.sqrt((query**2).sum(axis=-1)))


class _Group:
    """The vectors of some parts, for exact cosines with blocks of queries that each probe some of them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, part: np.ndarray, k: int):
        order = np.argsort(part, kind="stable")
        self.ids, self.rows, self.k = ids[order], rows[order], k
        self.unit = _normal(self.rows)
        self.parts, first = np.unique(part[order], return_index=True)
        self.edges = np.append(first, len(part))

    def hits(self, query: np.ndarray, asking: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, ...]:
        """(query, score, id, same) of the k best of each query, best first; query `asking[i]` probes part `asked[i]`.

        A block of cosines has CELLS numbers at most, and so have the rows that wait for their exact cosine.
        """
        unit, best = _normal(query), np.full((len(query), self.k), -np.inf)
        kept, waiting, n = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), [], 0
        by_part = np.argsort(asked, kind="stable")
        asking, asked = asking[by_part], asked[by_part]
        for i, part in enumerate(self.parts):
            lo, hi = self.edges[i : i + 2]
            own = asking[slice(*np.searchsorted(asked, [part, part + 1]))]
            step = max(CELLS // (hi - lo), 1)
            for at in range(0, len(own), step):
                q = own[at : at + step]
                near = unit[q] @ self.unit[lo:hi].T
                better = near.max(axis=1) >= best[q].min(axis=1) - 1e-9
                q, near = q[better], near[better]
                top = np.partition(near, hi - lo - self.k, axis=1)[:, -self.k :] if hi - lo > self.k else near
                best[q] = np.partition(np.hstack([best[q], top]), top.shape[1], axis=1)[:, -self.k :] if top.shape[1] else best[q]
                r, c = np.nonzero(near >= best[q].min(axis=1, keepdims=True) - 1e-9)
                waiting.append((q[r], lo + c, near[r, c]))
                n += len(r)
                if n > CELLS:
                    kept, waiting, n = self._settle(query, best, kept, waiting), [], 0
        q, row, score = self._settle(query, best, kept, waiting)
        return q, score, self.ids[row], (self.rows[row] == query[q]).all(axis=1)

    def _settle(self, query: np.ndarray, best: np.ndarray, kept: tuple, waiting: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best rows of each query by their exact cosines: those of `kept`, and those waiting that can still be among them."""
        floor = best.min(axis=1) - 1e-9
        q, row, score = ([x] for x in kept)
        for own, at, near in waiting:
            good = near >= floor[own]
            own, at = own[good], at[good]
            step = max(CELLS // query.shape[1], 1)
            for i in range(0, len(own), step):
                q.append(own[i : i + step])
                row.append(at[i : i + step])
                score.append(cosine(query[q[-1]], self.rows[row[-1]]))
        q, row, score = (np.concatenate(x) for x in (q, row, score))
        order = np.lexsort((self.ids[row], -score, q))
        place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
        order = order[place < self.k]
        return q[order], row[order], score[order]


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _search(held: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    """(qid, hits): the k best rows of each query of `sent` (shard, id, vec, parts) in each shard of `held` (likewise; its one part) that it is sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, group = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in range(3)])
            edges = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for lo, hi in zip([0, *edges], [*edges, len(keys)], strict=True):
                if lo == hi:
                    continue
                if key != tuple(keys[lo, :2]):
                    key, rows, group = tuple(keys[lo, :2]), [], None
                for at in range(lo, hi, BLOCK):
                    own = batch.slice(at, min(BLOCK, hi - at))
                    ids, vecs, parts = own.column("id").to_numpy(), _vectors(own.column("vec")), own.column("parts")
                    if keys[lo, 2] == 0:
                        rows.append((ids, vecs, parts.flatten().to_numpy()))
                    elif rows or group:
                        if not group:
                            group = _Group(*(np.concatenate(x) for x in zip(*rows, strict=True)), k)
                            rows = []
                        q, score, found, same = group.hits(vecs, np.repeat(np.arange(len(ids)), pc.list_value_length(parts).to_numpy()), parts.flatten().to_numpy())
                        of = pa.ListArray.from_arrays(np.searchsorted(q, np.arange(len(ids) + 1)).astype(np.int32), pa.StructArray.from_arrays([score, found, same], ["score", "id", "same"]))
                        yield pa.RecordBatch.from_arrays([pa.array(ids), of], ["qid", "hits"])

    return vectors.deal(held, sent).mapInArrow(run, "qid long, " + vectors.HIT.format("double"))


def _learn(kept: DataFrame, n: int, sample_rows: int) -> Parts:
    """The partitions: the first level here, the second one a task for each part, each from its own bounded sample."""
    sample = kept.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vec").toPandas()
    most = max(len(sample) // 48, 1).bit_length() - 1
    wanted = max((n // ROWS_A_PART).bit_length(), 3)
    parts = 1 << min(wanted, most, MAX_PARTS.bit_length() - 1)
    top = Parts(fit(_unit(sample["vec"]), parts), parts)
    below = 1 << min(max(wanted - parts.bit_length() + 1, 0), MAX_PARTS.bit_length() - 1) if parts == MAX_PARTS else 1
    if below == 1:
        return top
    drawn = kept.select("vec", "id").mapInPandas(lambda it: (x.assign(part=top.home(_unit(x["vec"]))) for x in it if len(x)), "vec array<double>, id long, part long")
    nth = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64("id"), "id"))
    drawn = drawn.withColumn("nth", nth).filter(F.col("nth") <= sample_rows).select("part", "vec")

    def inner(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "router": [pickle.dumps(fit(_unit(pdf["vec"]), below))]})

    enough = drawn.groupBy("part").applyInPandas(lambda pdf: inner(pdf) if len(pdf) >= 2 * below else pd.DataFrame({"part": [], "router": []}), "part long, router binary")
    return Parts(top.top, parts, below, {r["part"]: pickle.loads(r["router"]) for r in enough.collect()})  # at most MAX_PARTS small networks


def _probes(placed: DataFrame, asked: DataFrame, parts: Parts, k: int, recall: float, calibration: int) -> tuple[int, float]:
    """The fewest parts that hold the wanted share of the exact neighbours of some asked vectors, and the share they hold."""
    some = asked.orderBy(F.xxhash64("vec"), "qid").limit(calibration).select("vec").toPandas()
    queries = _unit(some["vec"])

    def nearest_here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)]
        for x in batches:
            if len(x):
                near = queries @ _unit(x["vec"]).T
                near[near > 1 - 1e-12] = -np.inf  # the vector itself and its copies
                both = np.hstack([held[0], near]), np.hstack([held[1], np.broadcast_to(x["shard"].to_numpy(), near.shape)])
                top = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
                held = [np.take_along_axis(b, top, axis=1) for b in both]
        q, col = np.nonzero(held[0] > -np.inf)
        yield pd.DataFrame({"q": q, "score": held[0][q, col], "part": held[1][q, col]})

    flat = placed.select("vec", "shard").mapInPandas(nearest_here, "q long, score double, part long")
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    true = flat.withColumn("nth", nth).filter(F.col("nth") <= k).select("q", "part").toPandas()  # at most calibration * k rows
    if not len(true):
        return 1, 1.0
    place = np.argsort(parts.ranked(queries), axis=1)  # the rank of each part
    needed = np.sort(place[true["q"], true["part"]])
    m = int(needed[min(int(np.ceil(recall * len(needed))), len(needed)) - 1]) + 1
    return m, float((needed < m).mean())


def _groups(counts: list, most: int) -> dict[int, tuple[int, int]]:
    """The first group of each part and into how many groups it is cut: neighbouring parts share a group of at most `most` rows, a larger part is cut by itself."""
    out, group, room = {}, -1, 0
    for part, n in sorted(counts):
        cuts = -(-n // most)
        if n > room:
            group += 1
            room = most if cuts == 1 else 0
        out[part] = (group, cuts)
        group += cuts - 1
        room -= n if cuts == 1 else 0
    return out


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 5, recall: float = 0.95, sample_rows: int = SAMPLE, calibration: int = CALIBRATION) -> DataFrame:
    """(query_id, rank, vec_id, score double) of vectors (id long, vec array<double>); a query's own row is no candidate of its."""
    spark = candidates.sparkSession
    kept = materialise(vectors.thin_copies(candidates, k + 1))
    asked = vectors.distinct_queries(queries)
    n = kept.count()
    if not n or asked.isEmpty():
        return vectors.answers(queries, asked, spark.createDataFrame([], vectors.BEST.format("double")), k)
    parts = _learn(kept, n, sample_rows)
    placed = materialise(kept.select("id", "vec").mapInPandas(lambda it: (x.assign(shard=parts.home(_unit(x["vec"]))) for x in it if len(x)), "id long, vec array<double>, shard long"))
    probes, reached = _probes(placed, asked, parts, k, recall, calibration)
    log.info("%d of %d parts hold %.3f of the exact neighbours", probes, parts.parts * parts.below, reached)
    width = kept.select(F.size("vec")).first()[0]
    groups = _groups(placed.groupBy("shard").count().collect(), min(PART_ROWS, max(GROUP_NUMBERS // width, 1), max(n // GROUPS, GROUP_ROWS)))  # a row a part
    blocks = F.broadcast(spark.createDataFrame([(p, f, c) for p, (f, c) in groups.items()], "part long, _first long, _cuts long"))
    one = F.array(F.col("part").cast("smallint")).alias("parts")
    held = placed.withColumnRenamed("shard", "part").join(blocks, "part").select((F.col("_first") + F.pmod(F.xxhash64("id", "vec"), F.col("_cuts"))).alias("shard"), "id", "vec", one)
    wanted = [(p, f + i) for p, (f, c) in groups.items() for i in range(c)]
    of_part, of_group = (np.array(x) for x in zip(*wanted, strict=True))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROUTED):
                own = batch.slice(at, ROUTED)
                probed = np.zeros((own.num_rows, parts.parts * parts.below), bool)
                np.put_along_axis(probed, parts.ranked(_normal(_vectors(own.column("vec"))))[:, :probes], True, axis=1)
                q, i = np.nonzero(probed[:, of_part])  # groups rise with i
                start = np.flatnonzero(np.append(True, (q[1:] != q[:-1]) | (of_group[i[1:]] != of_group[i[:-1]]))) if len(q) else q
                for b in range(0, len(start), BLOCK):
                    first = start[b : b + BLOCK]
                    stop = start[b + BLOCK] if b + BLOCK < len(start) else len(q)
                    some = own.take(pa.array(q[first]))
                    lists = pa.ListArray.from_arrays(np.append(first, stop).astype(np.int32) - np.int32(first[0]), of_part[i[first[0] : stop]].astype(np.int16))
                    yield pa.RecordBatch.from_arrays([pa.array(of_group[i[first]].astype(np.int64)), some.column("qid"), some.column("vec"), lists], ["shard", "id", "vec", "parts"])

    sent = asked.mapInArrow(route, "shard long, id long, vec array<double>, parts array<smallint>")
    hits = _search(held, sent, k + 1)
    return vectors.answers(queries, asked, materialise(vectors.best(hits, k + 1)), k)


def search(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = 0.95) -> DataFrame:
    """`nearest` over a table: rows for which `is_query` (of column id) holds ask, all rows are candidates."""
    rows = materialise(vectors.usable(df, id_col, vec_col, nonzero=True))
    return vectors.by_length(rows, lambda own: nearest(own, own.filter(is_query), k, recall))
