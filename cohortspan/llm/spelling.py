"""Spelling variants: words one edit apart, found by probing generated edits against broadcast Bloom filters.

The vocabulary is counted by one shuffle. From it a blocked Bloom filter is built for every word length (words of 64 code points and
more share one): a word sets one bit in each of the eight lanes of one block, and the lanes of a block are put together by `bit_or`
in Spark. All filters together take at most `filter_mb`, so what is broadcast has a bound whatever the vocabulary; beyond it
only more false positives pass. Every word then generates its edits: each code point left out, and each replaced by a greater one
of the alphabet. An insertion is the other word's deletion, and a replacement by a smaller code point is the other
word's replacement, so each near pair is generated on one side, once. Edits are hashed from prefix sums, not spelled. Only those that
the filter of their length lets through are spelled and shuffled to an exact join with the vocabulary, which removes false
positives.

A word's form is its most frequent near word if that is `ratio` times as frequent or more; its root is the last of the chain
of forms. A chain grows by `ratio` at each step, so pointer doubling needs a number of joins that the largest count bounds.

Results for special cases: a null or empty text has no words; a null id counts as an empty one in the rule that drops
code points; repeated rows count again; ties between near words go to the first in code-point order; a word without near words
is its own root; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_arrow, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of this many code points and more share one filter.
LONG = 64
LANES = 8
#: Edits that are hashed at a time.
AT_ONCE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Odd multipliers, one for each lane of a block.
_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)


def _slipped(run: Column, id_: Column, every: int) -> Column:
    """The run, without one code point if `every` divides the CRC-32 of `<id>:<run>`."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = "A-Za-zÀ-ÿ", min_chars: int = 6, min_count: int = 5, slip: int | None = 199) -> DataFrame:
    """(word, n) of all runs of `letters`, A-Z lower-cased, with at least `min_chars` code points and `min_count` occurrences.

    With `slip`, a run loses a code point where its CRC-32 with the id is divisible by it.
    """
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"[{letters}]{{{min_chars},}}+"), F.lit(0))).alias("run"))
    word = _slipped(F.col("run"), F.col("id"), slip) if slip else F.col("run")
    counted = runs.select(word.alias("word")).filter(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _codes(words: list[str]) -> np.ndarray:
    """A row of code points for each of some words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def _weights(length: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(length, _BASE, np.uint64), dtype=np.uint64)])


def _hash(codes: np.ndarray) -> np.ndarray:
    return (codes * _weights(codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def _places(hashes: np.ndarray, length: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and the 32 bits that choose its bit in every lane."""
    h = hashes + np.uint64(length)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), h.astype(np.uint32)


def _bits(low: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << (low * _SALTS[lane] >> np.uint32(27))


def _by_length(words: list[str]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        found.setdefault(len(w), []).append(i)
    return found


def _set_bits(batches: Iterator[pa.RecordBatch], blocks: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        for length, own in _by_length(words).items():
            block, low = _places(_hash(_codes([words[i] for i in own])), length, blocks[min(length, LONG)])
            lanes = [pa.array(_bits(low, i).astype(np.int64)) for i in range(LANES)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), min(length, LONG), np.int32)), pa.array(block), *lanes], names=["length", "block", *(f"lane{i}" for i in range(LANES))])


def build_filters(words: DataFrame, bits_per_word: int = 16, filter_mb: int = 64) -> dict[int, np.ndarray]:
    """For each length an array (blocks, LANES) of 32-bit lanes; all of them take at most about `filter_mb` MB on the driver."""
    length = F.least(F.char_length("word"), F.lit(LONG)).alias("length")
    counts = {r["length"]: r["n"] for r in words.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most LONG rows
    bits = min(float(bits_per_word), filter_mb * 8e6 / max(sum(counts.values()), 1))
    blocks = {k: max(math.ceil(n * bits / (32 * LANES)), 1) for k, n in counts.items()}
    lanes = [f"lane{i}" for i in range(LANES)]
    rows = words.select("word").mapInArrow(partial(_set_bits, blocks=blocks), "length int, block long, " + ", ".join(f"{c} long" for c in lanes))
    filters = {k: np.zeros((n, LANES), np.uint32) for k, n in blocks.items()}
    found = rows.groupBy("length", "block").agg(*(F.bit_or(c).alias(c) for c in lanes)).toArrow()
    if found.num_rows:
        own, block, *values = (found.column(i).to_numpy() for i in range(2 + LANES))
        values = np.stack(values, axis=1).astype(np.uint32)
        for k, f in filters.items():
            f[block[own == k]] = values[own == k]
    return filters


def _passing(filters: dict[int, np.ndarray], hashes: np.ndarray, length: int) -> np.ndarray:
    """Places of the hashes that the filter of words of `length` code points lets through."""
    own = filters.get(min(length, LONG))
    if own is None or not len(hashes):
        return np.zeros(0, np.int64)
    block, low = _places(hashes, length, len(own))
    left = np.arange(len(hashes))
    for lane in range(LANES):
        hit = own[block[left], lane] & _bits(low[left], lane) != 0
        left = left[hit]
    return left


def edits(words: list[str], filters: dict[int, np.ndarray], alphabet: np.ndarray) -> tuple[list[int], list[str]]:
    """Edits of each word that pass: the word's place in `words`, and the edit. No edit of a word is given twice."""
    owners: list[int] = []
    found: list[str] = []
    for length, places in _by_length(words).items():
        weights = _weights(length)
        step = max(AT_ONCE // max(length * len(alphabet), 1), 1)
        for at in range(0, len(places), step):
            own = places[at : at + step]
            codes = _codes([words[i] for i in own])
            before = np.concatenate([np.zeros((len(own), 1), np.uint64), np.cumsum(codes * weights[:-1], axis=1, dtype=np.uint64)], axis=1)
            whole = before[:, -1:]
            if min(length - 1, LONG) in filters:
                shorter = before[:, :-1] + (whole - before[:, 1:]) * _INVERSE
                fresh = np.ones(codes.shape, bool)
                fresh[:, 1:] = codes[:, 1:] != codes[:, :-1]  # of equal neighbours only the first is left out
                row, place = np.nonzero(fresh)
                for k in _passing(filters, shorter[row, place], length - 1):
                    w = words[own[row[k]]]
                    owners.append(own[row[k]])
                    found.append(w[: place[k]] + w[place[k] + 1 :])
            wide = max(AT_ONCE // max(len(alphabet), 1), 1)
            for left in range(0, length, wide):  # one slice, but for very long words
                row, place, letter = np.nonzero(alphabet > codes[:, left : left + wide, None])
                place += left
                changed = whole[row, 0] + (alphabet[letter] - codes[row, place]) * weights[place]
                for k in _passing(filters, changed, length):
                    w = words[own[row[k]]]
                    owners.append(own[row[k]])
                    found.append(w[: place[k]] + chr(int(alphabet[letter[k]])) + w[place[k] + 1 :])
    return owners, found


def _probe(batches: Iterator[pa.RecordBatch], filters, alphabet: list[int]) -> Iterator[pa.RecordBatch]:
    letters = np.array(alphabet, np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            owners, found = edits(part.column(0).to_pylist(), filters.value, letters)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owners, pa.int64())), part.column(1).take(pa.array(owners, pa.int64())), pa.array(found, pa.string())], names=["word", "n", "edit"])
        free_arrow()


def near_pairs(words: DataFrame, bits_per_word: int = 16, filter_mb: int = 64) -> DataFrame:
    """(word, n, near, near_n) for all words (word, n) one edit apart, each pair once."""
    filters = build_filters(words, bits_per_word, filter_mb)
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct()
    alphabet = sorted(ord(r["c"]) for r in letters.collect())  # as many rows as the class of letters has
    shared = words.sparkSession.sparkContext.broadcast(filters)
    edited = words.select("word", "n").mapInArrow(partial(_probe, filters=shared, alphabet=alphabet), "word string, n long, edit string")
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return edited.join(exact, F.col("edit") == F.col("near")).drop("edit")


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, root) for rows (word, form), where following forms takes at most `longest` steps."""
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(longest - 1, 0).bit_length()):
        found = materialise(found)
        further = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        found = found.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return found


def variants(words: DataFrame, ratio: int = 5, bits_per_word: int = 16, filter_mb: int = 64) -> DataFrame:
    """Words (word, n) with form, root, n_near and form_n."""
    words = materialise(words)
    most, least = words.agg(F.max("n"), F.min("n")).first()
    pairs = near_pairs(words, bits_per_word, filter_mb)
    both = pairs.union(pairs.select("near", "near_n", "word", "n")) if most else pairs
    best = F.min(F.struct((-F.col("near_n")).alias("rare"), F.col("near").alias("near"))).alias("best")
    found = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = words.join(found, "word", "left").withColumn("_is", -F.col("best.rare") >= ratio * F.col("n"))
    found = materialise(
        found.select("word", F.when(F.col("_is"), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("_is"), -F.col("best.rare")).alias("form_n"))
    )
    steps, n = 0, least or 1
    while n * ratio <= (most or 0):
        steps, n = steps + 1, n * ratio
    ended = roots(found.filter("form is not null"), steps)
    return found.join(ended, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
