"""Best-fit packing of token sequences after Martello and Toth's dominance reduction.

All pieces of one length are alike, so the instance is the histogram of lengths: at most `capacity` rows, whatever the
corpus. Reduction and best fit run on the histogram and give patterns (lengths that share a sequence, how often);
Spark then numbers the pieces of each length and deals them to the patterns' places.

Results for special cases: a null text counts as empty and gives one piece that holds only the end id; repeated rows
and null ids are kept and packed like others; pieces of equal length are dealt in the
order in which they are held; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .common import free_arrow, materialise, number_within


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[int]]], dict[int, int]]:
    """Sequences that some best packing holds, as (times, lengths), and the counts of what is left.

    Largest length first, j with room r = capacity - j: nothing else fits, so j stands alone; a piece of exactly r
    fills it and dominates every other company; or no two remaining pieces fit into r together, so the largest that
    fits dominates.
    """
    left = {s: n for s, n in counts.items() if n}
    sizes = sorted(left)
    fixed: list[tuple[int, list[int]]] = []

    def take(times: int, lengths: list[int]) -> None:
        fixed.append((times, lengths))
        for s in lengths:
            left[s] -= times
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    for j in sorted(left, reverse=True):
        while left.get(j):
            room = capacity - j
            two = [s for s in sizes[:3] for _ in range(min(3, left[s] - (s == j)))][:2]
            if not two or two[0] > room:
                take(left[j], [j])
            elif left.get(room, 0) > (room == j):
                take(left[j] // 2 if room == j else min(left[j], left[room]), [j, room])
            elif len(two) < 2 or sum(two) > room:
                best = sizes[bisect_left(sizes, room + 1) - 1]
                if best == j and left[j] < 2:
                    best = sizes[bisect_left(sizes, j) - 1]
                take(left[j] // 2 if best == j else 1 if j in two or best in two else min(left[j], left[best]), [j, best])
            else:
                break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit, largest length first: each piece goes where the least room stays. As (times, lengths)."""
    groups: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)  # by room
    rooms: list[int] = []

    def put(room: int, times: int, lengths: list[int]) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((times, lengths))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            k = bisect_left(rooms, s)
            if k < len(rooms):
                room = rooms[k]
                times, lengths = groups[room].pop()
                if not groups[room]:
                    rooms.pop(k)
            else:
                room, times, lengths = capacity, n, []
            each = min(room // s, n)
            used = min(times, n // each)
            if lengths and used < times:
                put(room, times - used, lengths)
            put(room - each * s, used, lengths + [s] * each)
            n -= used * each
    return [g for room in groups for g in groups[room]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def _places(patterns: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first sequence, copies in a sequence, offset of the first copy)."""
    rank: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for s in sorted(set(lengths), reverse=True):
            copies = lengths.count(s)
            rows[s].append((rank[s], sequence, copies, offset))
            rank[s] += times * copies
            offset += s * copies
        sequence += times
    return {s: np.array(x, np.int64) for s, x in rows.items()}


def _cut(batches: Iterator[pa.RecordBatch], ranks: str, capacity: int, end_id: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = pretokens.WordEncoder(ranks)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            source, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k in range(len(cuts) - 1):
                    own = ids[cuts[k] : cuts[k + 1]]
                    source.append(i)
                    piece.append(k)
                    start.append(cuts[k])
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
                    if keep_ids:
                        kept.append(own.astype(np.int32))
            columns = [part.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, names + ["ids"] * keep_ids)
        free_arrow()


def pieces(docs: DataFrame, ranks: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Documents as pieces of at most `capacity` ids, the end id included. Only longer documents are cut; the first piece takes the rest."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    cut = partial(_cut, ranks=ranks, capacity=capacity, end_id=end_id, keep_ids=keep_ids)
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def pack(docs: DataFrame, ranks: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """`pieces` with sequence_id and offset: sequences hold at most `capacity` ids, without gaps."""
    cut = materialise(pieces(docs, ranks, capacity, end_id, id_col, text_col, keep_ids))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    places = _places(plan(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        size, number = length.to_numpy(), rank.to_numpy()
        for s in np.unique(size):
            own = np.flatnonzero(size == s)
            rows = places[int(s)]
            row = rows[np.searchsorted(rows[:, 0], number[own], side="right") - 1]
            t = number[own] - row[:, 0]
            sequence[own] = row[:, 1] + t // row[:, 2]
            offset[own] = row[:, 3] + t % row[:, 2] * s
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = number_within(cut, "length", "_rank")
    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*cut.columns, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))
