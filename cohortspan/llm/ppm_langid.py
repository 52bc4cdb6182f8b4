"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes deep holds how often each byte followed (statistics are frozen
after learning). A byte's probability is its share in the deepest context that saw it; each shallower step first pays
that context's escape probability (method C: distinct followers / (occurrences + distinct followers)), down to a
uniform byte. A text's language is the one whose tree codes it in the fewest bits. Whether it is any learned language at all is
told by the bits themselves (`plausible`): the share of the best language is near 1 for a foreign text too.

Since statistics are frozen, the cost of a byte depends on the three bytes before it and itself. Each level of the trees keeps its
grams (a context and the byte after it) of all languages as one sorted array with exact costs beside it; a text's grams
are found in it, and those never met go one level up and pay the escape. No gram that was learned is left out: the arrays have as
many rows as the learning sample has different grams.

Learning takes at most `per_language` labelled documents of each language (those with the smallest hash of id and text, repeated
rows once); their whole texts count. Zero bytes stand before a text's start.

Results for special cases: a null text or one without a letter is `und` with score 0; so is every text if nothing could be
learned; equal costs go to the language first by name; repeated rows and null ids are kept; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_arrow, held_out

DEPTH = 3
#: Bytes that are scored at a time; a longer text is scored in parts.
WINDOW = 250_000
#: Bits that a text may cost beyond its plain bytes, see `plausible`.
SLACK = 512.0
#: The trees that this Python worker built last, by model.
_built: dict = {}


def _join(padded: bytes) -> np.ndarray:
    """The DEPTH + 1 bytes that end at each position from the fourth on, as one number."""
    b = np.frombuffer(padded, np.uint8).astype(np.uint32)
    return b[:-3] << np.uint32(24) | b[1:-2] << np.uint32(16) | b[2:-1] << np.uint32(8) | b[3:]


def _grams(text: bytes) -> np.ndarray:
    return _join(bytes(DEPTH) + text)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            grams, n = np.unique(np.concatenate([_grams(t.encode()) for t in texts]), return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n})


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500) -> bytes:
    """Statistics of the trees. What reaches the driver is bounded by the sample of `per_language` documents."""
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("h"))
    rows = rows.filter("lang is not null and text is not null and text <> ''")
    # The rank needs no texts: they are read again for the chosen hashes only. Hash ranges are counted first, so a language's rank
    # is taken over the few ranges that hold its smallest hashes, however many documents it has.
    hashed = rows.select("lang", "h").distinct()
    ranges = min(max(rows.count() // (4 * per_language), 1), 1 << 16)
    hashed = hashed.withColumn("range", F.floor((F.col("h") / 2.0**64 + 0.5) * ranges))
    counted = hashed.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = counted.withColumn("before", before).filter(F.col("before") < per_language).select("lang", "range")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = hashed.join(F.broadcast(first), ["lang", "range"]).withColumn("nth", nth).filter(F.col("nth") <= per_language).select("lang", "h")
    sample = rows.join(F.broadcast(chosen), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.max("text").alias("text"))
    counted = sample.select("lang", "text").mapInPandas(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    counted = counted.sort_values(["lang", "gram"])
    code = counted["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.uint8)
    return pickle.dumps((langs, code, counted["gram"].to_numpy(np.uint32), counted["n"].to_numpy(np.uint32)))


class Trees:
    """Costs (natural logarithms of probabilities) of each byte after each context, for every language."""

    def __init__(self, model: bytes):
        self.langs, lang, gram, n = pickle.loads(model)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # by context length: grams, costs, contexts, escapes
        many = len(self.langs)
        for depth in range(DEPTH + 1):
            known, at = np.unique(gram & self._mask(depth), return_inverse=True)
            contexts = np.unique(known >> np.uint32(8))
            own = np.searchsorted(contexts, known >> np.uint32(8))
            count = np.bincount(at * many + lang, n, len(known) * many).reshape(-1, many) if many else np.zeros((0, 0))
            total, distinct = np.zeros((len(contexts), many)), np.zeros((len(contexts), many))
            np.add.at(total, own, count)
            np.add.at(distinct, own, count > 0)
            all_ = np.maximum(total + distinct, 1)
            escape = np.log(np.where(total > 0, distinct / all_, 1.0))
            cost = np.where(count > 0, np.log(np.maximum(count, 1) / all_[own]), escape[own] + self.cost(known, depth - 1))
            self.levels.append((known, cost, contexts, escape))

    @staticmethod
    def _mask(depth: int) -> np.uint32:
        """For a context of `depth` bytes and the byte after it."""
        return np.uint32((1 << 8 * (depth + 1)) - 1)

    @staticmethod
    def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(known, wanted)
        at[at == len(known)] = 0
        return at, known[at] == wanted

    def cost(self, grams: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        """A row for each gram, a column for each language."""
        if depth < 0:
            return np.full((len(grams), len(self.langs)), -np.log(256))
        known, costs, contexts, escapes = self.levels[depth]
        at, met = self._find(known, grams & self._mask(depth))
        out = costs[at]
        if not met.all():
            rest = (grams & self._mask(depth))[~met]
            own = self.cost(rest, depth - 1)
            at, met_context = self._find(contexts, rest >> np.uint32(8))
            own[met_context] += escapes[at[met_context]]
            out[~met] = own
        return out

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """The logarithm of each text's probability under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        parts, owners, size = [], [], 0

        def flush() -> None:
            owner = np.repeat(np.arange(len(parts)), [len(p) - DEPTH for p in parts])
            grams = _join(b"".join(parts))[np.arange(len(owner)) + DEPTH * owner]
            different, which = np.unique(grams, return_inverse=True)
            cost = self.cost(different)
            for k in range(out.shape[1]):
                np.add.at(out[:, k], owners, np.bincount(owner, cost[which, k], len(parts)))

        for i, text in enumerate(texts):
            for lo in range(0, len(text), WINDOW):
                parts.append((bytes(DEPTH) if lo == 0 else b"") + text[max(lo - DEPTH, 0) : lo + WINDOW])
                owners.append(i)
                size += len(parts[-1])
                if size >= WINDOW:
                    flush()
                    parts, owners, size = [], [], 0
        if parts:
            flush()
        return out


def _predict(batches: Iterator[pa.RecordBatch], model, text_at: int, kept: int) -> Iterator[pa.RecordBatch]:
    key = model.id
    if key not in _built:
        _built.clear()
        _built[key] = Trees(model.value)
    trees = _built[key]
    for batch in batches:
        langs, scores, bits = [], [], []
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            letters = part.column(part.num_columns - 1).to_pylist()
            if not trees.langs:
                langs += ["und"] * len(letters)
                scores += [0.0] * len(letters)
                bits += [None] * len(letters)
                continue
            texts = [(t or "").encode() for t in part.column(text_at).to_pylist()]
            logs = trees.costs(texts)
            best = logs.argmax(axis=1)
            share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for i, known in enumerate(letters):
                langs.append(trees.langs[best[i]] if known else "und")
                scores.append(float(share[i]) if known else 0.0)
                bits.append(float(-logs[i, best[i]] / np.log(2) / len(texts[i])) if known else None)
        names = [*batch.schema.names[:kept], "lang_pred", "score", "bits"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())], names=names)
        free_arrow()


def predict(docs: DataFrame, model: bytes, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` of every row with lang_pred, score (the share of the best language among all learned ones) and
    bits (code length a byte under the best language's tree; null for `und`)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the learning sample
    text = F.col(text_col).cast("string")
    inner = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    text_at = keep.index(text_col) if text_col in keep and docs.schema[text_col].dataType.simpleString() == "string" else len(keep)
    rows = docs.select(*inner, *[text.alias("_text")] * (text_at == len(keep)), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    types = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = rows.mapInArrow(partial(_predict, model=_Shared(shared), text_at=text_at, kept=len(keep)), f"{types}, lang_pred string, score double, bits double")
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score", "bits")


def plausible(text_col: str = "text") -> Column:
    """Whether the text of a row of `predict` may be of its language: the tree of the best language codes it in at most SLACK
    bits more than its plain bytes take. A tree that does worse has seen nothing like the text: another script, an
    unknown language, noise. Short texts pass, they show too little. Null for `und`."""
    return (F.col("bits") - 8) * F.octet_length(F.col(text_col).cast("string")) <= SLACK


class _Shared:
    """A broadcast value with a key for what a worker builds from it."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500, keep: list[str] | None = None) -> DataFrame:
    """Learn from the labelled rows of `docs` that are not held out, then predict every row."""
    model = learn(docs.filter(~held_out(F.col(id_col))), id_col, text_col, lang_col, per_language)
    return predict(docs, model, keep or [id_col], text_col)
