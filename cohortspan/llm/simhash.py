"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints of 64 bits link when at most three bits differ. Every distinct fingerprint that can have a link emits all
variants within half the radius: those of even weight the variants with one bit flipped, those of odd weight the variants with
one and with two (halves of three, rounded down and up, told apart by parity, since fingerprints one or three bits apart differ
in it and those two bits apart do not). Variants are shuffled; what meets on one is within three bits, and each member is
linked to the smallest fingerprint met there, so links are verified by construction and no pairs are listed, however many meet.

Which fingerprints can have a link is settled first, without loss: two within three bits agree in at least five of their eight
bytes. Each fingerprint sends every choice of five bytes to a shuffle and stays if another one has the same five. One without
such a neighbour has no link, and its ball need not be emitted.

Results for special cases: a null text or one without words has fingerprint zero and links like any other; null ids and
repeated rows are kept, each with its own row; a component without any id has a null component_id; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import components
from .common import free_arrow, materialise

#: Rows up to which a table of keys is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000

def hashes(text: str, width: int = 3, seed: int = 42) -> list[int]:
    """XXH64 of each shingle of `width` words; of the whole word sequence if it is shorter; none without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return []
    if len(words) < width:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    digest = xxhash.xxh64_intdigest
    return [digest(s, seed) for s in map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))]


def fingerprints_of(texts: list[str], width: int = 3) -> np.ndarray:
    """The fingerprint of each text, as uint64. A long text is summed in parts."""
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, text in enumerate(texts):
        own = hashes(text, width)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(own), 8192):
            part = np.array(own[at : at + 8192], "<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        out[i] = weights[2 * ones > len(own)].sum(dtype=np.uint64)
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slices = (batch.column(1).slice(at, 256).to_pylist() for at in range(0, batch.num_rows, 256))
        fps = [fingerprints_of([t or "" for t in texts], width).view(np.int64) for texts in slices]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(fps) if fps else [], pa.int64())], ["id", "fp"])
        free_arrow()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(`id_col`, fp long) for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(partial(_fingerprint, width=width), f"id {id_type}, fp long").withColumnRenamed("id", id_col)


def _flips(bits: int, weight: int) -> list[int]:
    return [v - (1 << 64) if v >> 63 else v for v in (sum(1 << b for b in c) for c in combinations(range(bits), weight))]


def _emit(df: DataFrame, masks: list[int], name: str, of: str) -> DataFrame:
    return df.withColumn("_mask", F.explode(F.array(*map(F.lit, masks)))).withColumn(name, F.col(of).bitwiseXOR(F.col("_mask"))).drop("_mask")


def linkable(distinct: DataFrame) -> DataFrame:
    """The fingerprints `fp` that agree with another one in five of eight bytes; all that have a link are among them."""
    choices = [sum(0xFF << 8 * b for b in c) for c in combinations(range(8), 5)]
    signed = [c - (1 << 64) if c >> 63 else c for c in choices]
    # a choice and its bytes as one number: two that share it by chance only send a ball too many
    keys = F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(c))) for i, c in enumerate(signed)))
    sent = distinct.select("fp", F.explode(keys).alias("key"))
    shared = materialise(sent.groupBy("key").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).filter("least <> most").select("key"))
    shared = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    return sent.join(shared, "key", "left_semi").select("fp").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints `fp`: enough to connect all that reach each other by steps of three bits.

    No edge joins fingerprints further apart, and no pair within three bits is left in two components.
    """
    near = materialise(linkable(distinct))
    odd = F.bit_count("fp") % 2 == 1
    even_one = _emit(near.filter(~odd), _flips(64, 1), "v", "fp")
    odd_one = _emit(near.filter(odd), _flips(64, 1), "v", "fp")
    odd_two = _emit(near.filter(odd), _flips(64, 2), "v", "fp")

    def star(members: DataFrame, around: DataFrame) -> DataFrame:
        centre = around.groupBy("v").agg(F.min("fp").alias("a"))
        return members.join(centre, "v").filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()

    return star(even_one, even_one).union(star(odd_two, even_one)).union(star(odd_one, odd_one)).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(`id_col`, fp long, component_id): component_id is the smallest id that links reach, its own included."""
    fps = materialise(fingerprints(docs, id_col, text_col, width))
    distinct = materialise(fps.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` for each component: the smallest id's (rows without an id come last), of several texts the one with the smallest MD5.

    Of rows that agree in id and text any one stays.
    """
    text = F.col(text_col).cast("string")
    own = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit("\n"), F.coalesce(text, F.lit(""))))
    key = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), own.alias("own"))
    rows = docs.withColumn("_own", own)
    found = classes(docs.select(key.alias("_key"), text.alias("_text")), "_key", "_text")
    chosen = found.select(F.col("component_id.own").alias("_own")).distinct()
    # repeated rows shrink to one in each partition before any shuffle
    return rows.dropDuplicates(["_own"]).join(chosen, "_own", "left_semi").drop("_own")
