"""Quality scores from supervised subword embeddings.

A document is the mean of learned vectors of its features: hashed words, a word that repeats the one before it,
and hashed character n-grams of its words, whose edges are marked. A softmax over the mean gives the score. Training is numpy stochastic
gradient descent (step sizes by AdaGrad) in one task over at most `max_rows` labelled documents; everything else is a
scan. The softmax is linear in the mean, so scoring looks up one number for each feature: the difference of the classes' products
with its vector.

Results for special cases: a null or empty text has no features and gets the score of the learned bias; labels that are null or
neither 0 nor 1 are left out; of several labels of a document the smallest counts, of
several texts of an id the first in order; without labels every score is 0.5; repeated rows
and null ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_arrow, held_out
from .pretokens import _powers

BUCKETS = 1 << 17
NGRAMS = (3, 4)
REPEATED, FIRST = 0, 1  # a reserved bucket, and the first of the others
_MIX = np.uint64(0xD6E8FEB86659FD93)


def features(text: str) -> np.ndarray:
    """The buckets of a text's features, repeats included. Words lie between ASCII white space."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(code):
        return np.zeros(0, np.int64)
    inside = (code != 32) & (code - np.uint32(9) > 4)
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    wide = code.astype(np.uint64) + np.uint64(1)
    power, inverse = _powers(len(code))
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(wide * power[: len(code)], out=total[1:])
    words = (total[ends] - total[starts]) * inverse[starts]
    # characters of words with one mark between words, and at both ends
    kept = inside.copy()
    kept[ends[ends < len(code)]] = True
    marked = np.concatenate([np.zeros(1, np.uint64), np.where(inside, wide, np.uint64(0))[kept], np.zeros(int(inside[-1]), np.uint64)])
    marks = np.concatenate([[0], np.cumsum(marked == 0)])
    found = [words]
    for n in NGRAMS:
        m = len(marked) - n + 1
        if m > 0:
            gram = np.full(m, n, np.uint64)
            for i in range(n):
                gram = gram * np.uint64(0x100000001B3) + marked[i : m + i]
            found.append(gram[marks[n - 1 : n - 1 + m] == marks[1 : 1 + m]])  # no mark but at the ends
    repeated = np.full(int((words[1:] == words[:-1]).sum()), REPEATED, np.int64)
    mixed = np.concatenate(found) * _MIX
    return np.concatenate([repeated, FIRST + ((mixed ^ mixed >> np.uint64(29)) * _MIX >> np.uint64(32)).astype(np.int64) % (BUCKETS - FIRST)])


def train(texts: list[str], labels: np.ndarray, dims: int = 8, epochs: int = 12, rate: float = 0.5, seed: int = 7) -> np.ndarray:
    """The number of each bucket, and the bias in front of them."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, dims)).astype(np.float32)
    out = rng.normal(0, 0.1, (2, dims)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_v, seen_o, seen_b = np.full(BUCKETS, 1e-8, np.float32), 1e-8, 1e-8
    docs = []
    for t in texts:
        own, n = np.unique(features(t), return_counts=True)
        docs.append((own.astype(np.int32), (n / max(n.sum(), 1)).astype(np.float32)))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(docs)):
            own, share = docs[i]
            mean = share @ vectors[own]
            logit = out @ mean + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ out
            grad_o = np.outer(p, mean)
            seen_o += float((grad_o**2).sum())
            seen_b += float((p**2).sum())
            out -= step / np.sqrt(seen_o) * grad_o
            bias -= step / np.sqrt(seen_b) * p
            seen_v[own] += share**2 * float((back**2).sum())
            vectors[own] -= (step * share / np.sqrt(seen_v[own]))[:, None] * back
    return np.concatenate([[bias[1] - bias[0]], vectors @ (out[1] - out[0])])


def _train(batches: Iterator[pd.DataFrame], options: dict) -> Iterator[pd.DataFrame]:
    rows = pd.concat(batches, ignore_index=True)
    rows = rows.sort_values(["order", "text"], kind="stable")
    if len(rows):
        yield pd.DataFrame({"model": [train(list(rows["text"]), rows["quality"].to_numpy(), **options).astype("<f8").tobytes()]})


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 4000, **options) -> np.ndarray:
    """The model from the documents of `labels` that are not held out: at most `max_rows`, those with the smallest hash of their id."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("quality")).filter("id is not null and quality in (0, 1)").filter(~held_out(F.col("id")))
    known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    chosen = known.groupBy("id").agg(F.min("quality").alias("quality")).withColumn("order", F.xxhash64("id")).orderBy("order", "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id", "order", "quality").agg(F.min("text").alias("text"))  # repeated ids count once
    found = texts.select("order", "text", "quality").repartition(1).mapInPandas(partial(_train, options=options), "model binary").collect()
    return np.frombuffer(found[0]["model"], "<f8") if found else np.zeros(1 + BUCKETS)


def _score(batches: Iterator[pa.RecordBatch], model, text_at: int, kept: int) -> Iterator[pa.RecordBatch]:
    values = np.frombuffer(model.value, "<f8")
    for batch in batches:
        out = []
        for t in chain.from_iterable(batch.column(text_at).slice(at, 256).to_pylist() for at in range(0, batch.num_rows, 256)):
            own = features(t or "")
            logit = values[0] + (values[1:][own].mean() if len(own) else 0.0)
            out.append(1 / (1 + np.exp(-logit)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(out, pa.float64())], names=[*batch.schema.names[:kept], "score"])
        free_arrow()


def score(docs: DataFrame, model: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` of every row with its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype("<f8").tobytes())  # BUCKETS numbers
    text_at = keep.index(text_col) if text_col in keep and docs.schema[text_col].dataType.simpleString() == "string" else len(keep)
    extra = [F.col(text_col).cast("string").alias("_text")] * (text_at == len(keep))
    rows = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), *extra)
    types = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = rows.mapInArrow(partial(_score, model=shared, text_at=text_at, kept=len(keep)), f"{types}, score double")
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "score")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7, max_rows: int = 4000, keep: list[str] | None = None) -> DataFrame:
    """score (how likely label 1 is) and predicted (1 from `threshold` on) for every row."""
    model = learn(docs, labels, id_col, text_col, label_col, max_rows)
    return score(docs, model, keep or [id_col], text_col).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
