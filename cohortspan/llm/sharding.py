"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Equal texts form a group. Every group is cut into as few equal pieces as keep each within an eighth of a shard, in bytes, tokens
and rows alike; that is one piece for all groups but the largest. Every piece is placed by itself, the largest first: it goes to the
shard where the dot product with what room is left is highest among those with room for its bytes. Products are whole numbers of any size,
so nothing is rounded. Pieces of at least 1 / LARGE of a shard are placed first, on the driver (3 LARGE for each shard at most,
whatever the corpus). All other groups are then dealt to tasks by hash; a task has an equal share of the room that is left in each shard and
places its groups in it one by one, by the same rule.

Results for special cases: a null text has no bytes, counts as an empty text and forms a group with the empty ones; repeated
rows and null ids are kept and get a slot each, and rows of one piece are told apart by their place, not by what they hold;
slots follow the order in which rows are held; ties in placing go to the lower shard; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, number_within

LARGE = 512
#: Groups that one task places, about.
TASK_GROUPS = 200_000
#: A piece of a group is at most this share of a shard.
PIECE = 1 / 8
_SIZES = ("size", "tokens", "rows")


def place(items: list[tuple[int, int, int]], room: list[list[int]], total: list[int], tasks: int = 1) -> list[int]:
    """The shard of each item (bytes, tokens, rows).

    `room` has three numbers for each shard and is used up: what is left, as a multiple of (sum of all items) / (shards * `tasks`) by
    `total`. A whole shard has `total` of each.
    """
    shards = len(room)
    # the product of need and room, item / total * left / total, for three kinds brought to one denominator
    total = [max(t, 1) for t in total]
    weight = [math.prod(t for j, t in enumerate(total) if j != k) ** 2 for k in range(3)]
    out = [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-max(x * math.prod(total[:k] + total[k + 1 :]) for k, x in enumerate(items[i])), i)):
        a, b, c = (x * w for x, w in zip(items[i], weight, strict=True))
        used = [x * shards * tasks for x in items[i]]
        fits = [s for s in range(shards) if room[s][0] >= used[0]]
        best = max(fits, key=lambda s: (room[s][0] * a + room[s][1] * b + room[s][2] * c, -s)) if fits else max(range(shards), key=lambda s: (room[s][0], -s))
        out[i] = best
        room[best] = [x - u for x, u in zip(room[best], used, strict=True)]
    return out


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", row_bytes: int = 8, large: int = LARGE) -> DataFrame:
    """(`id_col`, size, text_crc32, law, shard, slot, grown_shard). The law is `bytes`: the shards' sizes are near equal."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
            F.xxhash64(text).alias("_group"),
        )
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = rows.agg(*sums).first()
    full = {k: (total[k] or 0) / shards for k in _SIZES}
    groups = materialise(rows.groupBy("_group").agg(*sums))
    is_large = " or ".join(f"{k} * {large} >= {full[k]!r}D" for k in _SIZES if full[k]) or "false"
    pieces, n_items = [], 0
    for r in sorted(groups.filter(is_large).collect(), key=lambda r: r["_group"]):  # at most 3 * large * shards
        n = max(int(np.ceil(r[k] / (full[k] * PIECE))) for k in _SIZES if full[k])
        pieces.append((r["_group"], n_items, n))
        n_items += n
    cut = spark.createDataFrame(pieces, "_group long, _base int, _pieces int")
    # a row's number in the materialised table deals a group's rows to its pieces, also where all of them are alike
    piece = (F.col("_base") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_pieces"))).cast("int")
    known = rows.join(F.broadcast(cut), "_group", "left").withColumn("_item", piece)
    items = known.filter("_item is not null").groupBy("_item").agg(*sums).orderBy("_item").collect()  # a row a piece
    whole = [total[k] or 0 for k in _SIZES]
    room = [list(whole) for _ in range(shards)]
    found = [(r["_item"], s) for r, s in zip(items, place([tuple(r[k] for k in _SIZES) for r in items], room, whole), strict=True)]
    n_small = groups.count() - len(pieces)
    tasks = min(max(-(-n_small // TASK_GROUPS), 1), max(large // 2, 1))

    def place_small(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_group").reset_index(drop=True)
        own = place([tuple(x) for x in pdf[list(_SIZES)].to_numpy(np.int64).tolist()], [list(r) for r in room], whole, tasks)
        return pd.DataFrame({"_of": pdf["_group"], "_shard": own})

    small = groups.filter(f"not ({is_large})").withColumn("_task", F.pmod(F.xxhash64("_group"), F.lit(tasks)))
    small = small.groupBy("_task").applyInPandas(place_small, "_of long, _shard int")
    by_piece = spark.createDataFrame(found, "_item int, shard int")
    of_pieces = known.filter("_item is not null").join(F.broadcast(by_piece), "_item")
    of_groups = known.filter("_item is null").join(small, F.col("_group") == F.col("_of")).withColumn("shard", F.col("_shard"))
    columns = [id_col, "size", "text_crc32", "shard"]
    placed = materialise(of_pieces.select(columns).union(of_groups.select(columns)))
    numbered = number_within(placed, "shard", "slot")
    return numbered.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
