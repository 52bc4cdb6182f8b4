"""Phrases whose words go together, mined from an FM-index of each shard over word ids.

A task reads texts as a stream and cuts what it reads into shards of about `shard_words` words of one language; a shard is its words'
numbers, with a break where a phrase can't pass. Each shard is indexed by the BWT of its words and of their reverse (suffixes need to
be sorted by as many words only as phrases have). A phrase is an interval of either; it is extended to the left inside the first and to
the right inside the second, both intervals kept in step, so all phrases of one length are extended together, with their
counts. Counts are summed over shards.

No phrase reaches `min_count` if a word or a pair of neighbours in it doesn't. So words are counted first; shards are cut at rare words,
indexed, and their pairs counted; then shards are cut at rare pairs too, indexed again, and extended to `max_words`. What is left out
this way can't be in any result, and no count is estimated. Shards are joined with what is frequent in them by shard, never broadcast.

Words, pairs and longer phrases are summed in buckets, each of about as many as a task holds: a shard sends a bucket one row with all that
it has there, packed, and gets one row back that says which of them are frequent. So neither a (word, shard) nor a (pair, shard) is ever a row.

The score of a phrase is the lowest over its cuts in two parts of floor(`scale` a n / (l r)): a, l and r count the phrase and the
parts, n the words of the language; products are decimals of 38 digits. A phrase inside a longer one that occurs as often goes: then one that is
longer by one word at its left or right end occurs as often too, and `left_most` and `right_most` (the largest counts of
such extensions) tell.

Results for special cases: a null or empty text has no words; a null language is `und`; repeated rows count again; ties go by
count, then by phrase; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_arrow, materialise, scratch

# Where pieces end, and what separates words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b" \t"
_PLAIN = bytes.maketrans(BREAKS + b"\t", b"\n" * len(BREAKS) + b" ")
#: Bytes of a text that are split at a time.
SLICE = 1 << 20
#: Phrases that are extended at a time hold at most about so many occurrences.
AT_ONCE = 1 << 21
#: Words (or phrases) and pairs of all shards that a bucket holds on average at most; a small table is still dealt to some tasks.
WORDS, PAIRS, FEW, TASKS = 1 << 20, 1 << 22, 1 << 14, 64
#: Spreads pairs evenly over the numbers that they can be; its product is undone by that with its inverse.
_ODD = 0x9E3779B97F4A7C15


def _slices(text: str) -> Iterator[bytes]:
    """The text as bytes, A-Z lower-cased, `\\n` for every break and a blank for every space, in parts that end at a break."""
    data = text.encode("utf-8", "replace").lower().translate(_PLAIN)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > SLICE:
            cut = data.find(b"\n", at + SLICE)
            end = end if cut < 0 else cut + 1
        yield data[at:end]
        at = end


def _pack(ids: np.ndarray) -> bytes:
    return pc.cast(pa.array([len(ids)]), pa.int64()).to_numpy().tobytes() + pa.compress(ids.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed[:8], "<i8")[0])
    return np.frombuffer(pa.decompress(packed[8:], 4 * n, codec="zstd", asbytes=True), "<i4")


def _pack_numbers(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """Non-negative numbers, or ascending ones by their differences; first the lowest byte of all, then the next one, as far as any has one."""
    numbers = np.diff(numbers, prepend=numbers[:1] * 0) if ascending else numbers
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(numbers).to_bytes(7, "little") + bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack_numbers(packed: bytes, ascending: bool = False) -> np.ndarray:
    n, width = int.from_bytes(packed[:7], "little"), packed[7]
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = np.frombuffer(pa.decompress(packed[8:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    numbers = whole.reshape(-1).view("<u8")
    return np.cumsum(numbers, dtype=np.uint64) if ascending else numbers


def _pack_words(words: list[bytes]) -> bytes:
    """No word holds a break."""
    data = b"\n".join(words)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack_words(packed: bytes) -> list[bytes]:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True).split(b"\n")


def _buckets(rows: int, most: int) -> int:
    return max(-(-rows // most), min(TASKS, -(-rows // FEW)), 1)


def _by_bucket(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the words, those of a bucket together, and where each bucket starts among them."""
    bucket = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) * np.uint64(buckets) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


class _Shard:
    """Words of one language as numbers from 1 on; 0 is a break."""

    def __init__(self):
        self.known: dict[bytes, int] = {b"\n": 0}
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.size = 0

    def add(self, data: bytes) -> None:
        known = self.known
        words = [w for w in data.replace(b"\n", b" \n ").split(b" ") if w]
        for w in words:
            if w not in known:
                known[w] = len(known)
        self.parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(words) + 1

    def rows(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words, how often each occurs, and the numbers of the shard, where no two breaks are neighbours."""
        ids = _tight(np.concatenate(self.parts))
        counts = np.bincount(ids, minlength=len(self.known))[1:]
        return list(self.known)[1:], counts, ids


def _tight(ids: np.ndarray) -> np.ndarray:
    """Without breaks next to breaks; a break at either end."""
    ids = np.concatenate([np.zeros(1, np.int32), ids, np.zeros(1, np.int32)])
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0)
    return ids[keep]


_SHARD_TYPES = "lang string, shard long, many int, n long, words binary, counts binary, ids binary"


def _cut_shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    open_: dict[str, _Shard] = {}
    made = TaskContext.get().partitionId() << 32

    def close(lang: str) -> pa.RecordBatch:
        nonlocal made
        words, counts, ids = open_.pop(lang).rows()
        made += 1
        row = {"lang": lang, "shard": made, "many": len(words), "n": int(counts.sum()), "words": _pack_words(words), "counts": _pack_numbers(counts), "ids": _pack(ids)}
        return _batch([row], _SHARD_TYPES)

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for data in _slices(text or ""):
                    shard = open_.setdefault(lang, _Shard())
                    shard.add(data)
                    if shard.size >= shard_words:
                        yield close(lang)
        free_arrow()
    for lang in sorted(open_):
        yield close(lang)


def _bwt(ids: np.ndarray, depth: int) -> np.ndarray:
    """The number before each suffix, suffixes sorted by their first `depth` numbers (numbers beyond the end are 0)."""
    rank, known = ids.astype(np.int64), 1

    def after(values: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([values[by:], np.zeros(min(by, len(values)), values.dtype)])[: len(values)]

    while True:
        step = min(known, depth - known)
        if step == 0:
            order = np.argsort(rank, kind="stable")
            break
        key = rank * np.int64(rank.max() + 1) + after(rank, step)
        known += step
        order = np.argsort(key, kind="stable")
        if known == depth:
            break
        ordered = key[order]
        rank = np.empty(len(ids), np.int64)
        # the rank of what lies beyond the end is that of breaks alone, the smallest there is
        rank[order] = np.concatenate([np.zeros(1, np.int64), np.cumsum(ordered[1:] != ordered[:-1])])
    return ids[order - 1]


class BiIndex:
    """Both BWTs of a shard, each made when it is first needed. The shard starts and ends with a break."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.depth, self.many = ids, depth, int(ids.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=self.many))])
        self.sides: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def side(self, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """The BWT that extensions to this side read, and its (number, place) keys in order: the place of a key is C + Occ."""
        if left not in self.sides:
            bwt = _bwt(self.ids if left else self.ids[::-1], self.depth)
            key = bwt.astype(np.int64) * len(bwt) + np.arange(len(bwt))
            key.sort(kind="stable")
            self.sides[left] = bwt, key
        return self.sides[left]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All single words: the phrases (a row of numbers each), their intervals' starts in both indexes, and counts."""
        word = np.arange(1, self.many)
        count = np.diff(self.first)[1:]
        word = word[count > 0]
        start = self.first[word]
        return word[:, None].astype(np.int32), start, start.copy(), count[word - 1]

    def extend(self, phrases, starts, mirrored, counts, left: bool):
        """All phrases longer by one word at one side. `starts` are in the index of that side, `mirrored` in the other one."""
        bwt, keys = self.side(left)
        out = []
        ends = np.cumsum(counts)
        at = 0
        while at < len(counts):
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")), at + 1)
            n = counts[at:to]
            total = int(n.sum())
            owner = np.repeat(np.arange(at, to), n)
            within = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            key = owner * np.int64(self.many) + bwt[starts[owner] + within]
            pair, count = np.unique(key, return_counts=True)
            owner, word = pair // self.many, pair % self.many
            before = np.cumsum(count) - count  # inside an owner: how many occurrences go on with a smaller number
            before -= before[np.searchsorted(owner, owner)]
            real = word > 0
            owner, word, count, before = owner[real], word[real], count[real], before[real]
            own = np.searchsorted(keys, word * len(bwt) + starts[owner])
            grown = word[:, None].astype(np.int32)
            grown = np.concatenate([grown, phrases[owner]] if left else [phrases[owner], grown], axis=1)
            out.append((grown, own, mirrored[owner] + before, count))
            at = to
        if not out:
            return np.zeros((0, phrases.shape[1] + 1), np.int32), starts[:0], starts[:0], counts[:0]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def phrases_of(ids: np.ndarray, shortest: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the different phrases inside a shard's pieces (a row of numbers each) and their counts."""
    index = BiIndex(ids, longest)
    phrases, fwd, rev, counts = index.words()
    if shortest <= 1:
        yield phrases, counts
    for length in range(2, longest + 1):
        if length % 2 == 0:
            phrases, fwd, rev, counts = index.extend(phrases, fwd, rev, counts, True)
        else:
            phrases, rev, fwd, counts = index.extend(phrases, rev, fwd, counts, False)
        if length >= shortest:
            yield phrases, counts


_DEALT_TYPES = "bucket int, shard long, lang string, words binary, counts binary"


def _deal(lang: str, shard: int, words: list[bytes], counts: np.ndarray, buckets: int) -> list[dict]:
    """One row for each bucket in which the shard has words or phrases."""
    order, start = _by_bucket(words, buckets)
    rows = []
    for bucket in np.flatnonzero(np.diff(start)).tolist():
        own = order[start[bucket] : start[bucket + 1]]
        rows.append({"bucket": bucket, "shard": shard, "lang": lang, "words": _pack_words([words[i] for i in own.tolist()]), "counts": _pack_numbers(counts[own])})
    return rows


def _deal_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield _batch(_deal(row["lang"], row["shard"], _unpack_words(row["words"]), _unpack_numbers(row["counts"]), buckets), _DEALT_TYPES)
        free_arrow()


_FOUND_TYPES = "bucket int, lang string, word string, n long, rank int, shard long, places binary, ranks binary"


def _sum_words(dealt: pa.Table, min_count: int, answer: bool) -> pa.Table:
    """Frequent words or phrases of a bucket, ranked from 0; if `answer`, also a row for each shard: the places of those among what it sent."""
    lists = [_unpack_words(x) for x in dealt.column("words").to_pylist()]
    counts = np.concatenate([_unpack_numbers(x) for x in dealt.column("counts").to_pylist()]).astype(np.int64)
    names = sorted(set(dealt.column("lang").to_pylist()))
    lang = np.repeat([names.index(x) for x in dealt.column("lang").to_pylist()], [len(x) for x in lists])
    coded = pa.concat_arrays([pa.array(x, pa.large_binary()) for x in lists]).dictionary_encode()
    key, of = np.unique(coded.indices.to_numpy().astype(np.int64) * len(names) + lang, return_inverse=True)
    sums = np.zeros(len(key), np.int64)
    np.add.at(sums, of, counts)
    often = sums >= min_count
    rank = np.cumsum(often) - 1
    bucket = dealt.column("bucket")[0].as_py()
    word = coded.dictionary.take(pa.array(key[often] // len(names))).to_pylist()
    rows = [{"bucket": bucket, "lang": names[x], "word": w.decode("utf-8", "replace"), "n": n, "rank": r} for r, (x, w, n) in enumerate(zip((key[often] % len(names)).tolist(), word, sums[often].tolist(), strict=True))]
    at = 0
    for shard, own in zip(dealt.column("shard").to_pylist(), lists, strict=True) if answer else ():
        mine = of[at : at + len(own)]
        at += len(own)
        if (places := np.flatnonzero(often[mine])).size:
            rows.append({"bucket": bucket, "shard": shard, "places": _pack_numbers(places, True), "ranks": _pack_numbers(rank[mine[places]])})
    return _table(rows, _FOUND_TYPES)


def _bits(many: int) -> int:
    return max((many * many - 1).bit_length(), 1)


def _mixed(first: np.ndarray, second: np.ndarray, many: int) -> np.ndarray:
    """One number for each pair of numbers below `many`, spread evenly below 2 ** _bits(many), and never the same one for two pairs."""
    return (first.astype(np.uint64) * np.uint64(many) + second.astype(np.uint64)) * np.uint64(_ODD) & np.uint64((1 << _bits(many)) - 1)


def _unmixed(mixed: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    pair = mixed * np.uint64(pow(_ODD, -1, 1 << 64)) & np.uint64((1 << _bits(many)) - 1)
    return (pair // np.uint64(many)).astype(np.int64), (pair % np.uint64(many)).astype(np.int64)


_PAIR_TYPES = "lang string, shard long, many int, pairs binary, counts binary, words binary, wids binary, ids binary"


def _pairs(frequent: pa.Table, shard: pa.Table, buckets: int, width: int) -> pa.Table:
    """A shard cut at rare words, and its pairs. frequent: what the buckets of words answered; shard: one row."""
    row = shard.to_pylist()[0]
    ids, words = _unpack(row["ids"]), _unpack_words(row["words"])
    order, start = _by_bucket(words, buckets)
    local, wid = [], []
    for x in frequent.to_pylist():
        local.append(order[start[x["bucket"]] + _unpack_numbers(x["places"], True).astype(np.int64)])
        wid.append(x["bucket"] * width + _unpack_numbers(x["ranks"]).astype(np.int64))
    local, wid = np.concatenate(local), np.concatenate(wid)
    by = np.argsort(local)
    local, wid = local[by], wid[by]
    new = np.zeros(len(words) + 1, np.int32)
    new[local + 1] = np.arange(1, len(local) + 1)
    cut = _tight(new[ids])
    pairs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for phrases, n in phrases_of(cut, 2, 2):
        pairs = _mixed(wid[phrases[:, 0] - 1], wid[phrases[:, 1] - 1], buckets * width)
        by = np.argsort(pairs)
        pairs, counts = pairs[by], n[by]
    row |= {"many": len(pairs), "pairs": _pack_numbers(pairs, True), "counts": _pack_numbers(counts), "words": _pack_words([words[i] for i in local.tolist()]), "wids": _pack_numbers(wid), "ids": _pack(cut)}
    return _table([row], _PAIR_TYPES)


_PART_TYPES = "bucket int, shard long, pairs binary, counts binary"


def _deal_pairs(batches: Iterator[pa.RecordBatch], buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A shard's pairs, a row for each bucket in which it has any."""
    bounds = np.array([(b << bits) // buckets for b in range(buckets + 1)], np.uint64)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            pairs, counts = _unpack_numbers(row["pairs"], True), _unpack_numbers(row["counts"])
            start = np.searchsorted(pairs, bounds)
            cuts = [(b, slice(start[b], start[b + 1])) for b in np.flatnonzero(np.diff(start)).tolist()]
            yield _batch([{"bucket": b, "shard": row["shard"], "pairs": _pack_numbers(pairs[own], True), "counts": _pack_numbers(counts[own])} for b, own in cuts], _PART_TYPES)
        free_arrow()


_NEAR_TYPES = "shard long, pairs binary, counts binary"


def _sum_pairs(dealt: pa.Table, min_count: int) -> pa.Table:
    """Frequent pairs of a bucket with their sums, in a row without a shard, and for each shard which of them it has."""
    lists = [_unpack_numbers(x, True) for x in dealt.column("pairs").to_pylist()]
    pairs, counts = np.concatenate(lists), np.concatenate([_unpack_numbers(x) for x in dealt.column("counts").to_pylist()]).astype(np.int64)
    by = np.argsort(pairs, kind="stable")
    pairs = pairs[by]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    pairs, sums = pairs[first], np.add.reduceat(counts[by], first)
    pairs, sums = pairs[sums >= min_count], sums[sums >= min_count]
    rows = [{"pairs": _pack_numbers(pairs, True), "counts": _pack_numbers(sums)}] if len(pairs) else []
    for shard, own in zip(dealt.column("shard").to_pylist(), lists, strict=True) if len(pairs) else ():
        if (held := own[_among(own, pairs)]).size:
            rows.append({"shard": shard, "pairs": _pack_numbers(held, True)})
    return _table(rows, _NEAR_TYPES)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ones."""
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _pair_rows(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            first, second = _unmixed(_unpack_numbers(pairs, True), many)
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), pa.array(_unpack_numbers(counts).astype(np.int64))], names=["wid", "_b", "n"])


def _longer(frequent: pa.Table, shard: pa.Table, longest: int, many: int, buckets: int) -> pa.Table:
    """Phrases of three words and more of a shard cut at rare pairs, dealt to buckets. frequent: pairs; shard: one row."""
    row = shard.to_pylist()[0]
    ids, words = _unpack(row["ids"]), _unpack_words(row["words"])
    wid = np.concatenate([np.zeros(1, np.uint64), _unpack_numbers(row["wids"])])
    known = np.sort(np.concatenate([_unpack_numbers(x, True) for x in frequent.column("pairs").to_pylist()]))
    apart = ~_among(_mixed(wid[ids[:-1]], wid[ids[1:]], many), known) & (ids[:-1] > 0) & (ids[1:] > 0)
    cut = np.insert(ids, np.flatnonzero(apart) + 1, 0)
    # of what is left, single words can't be in a phrase
    alone = (cut[1:-1] > 0) & (cut[:-2] == 0) & (cut[2:] == 0)
    cut[1:-1][alone] = 0
    cut = _tight(cut)
    text = pa.array([b"", *words], pa.binary())
    joined, counts = [], [np.zeros(0, np.int64)]
    for phrases, n in phrases_of(cut, 3, longest) if longest >= 3 else ():
        joined += pc.binary_join_element_wise(*(text.take(pa.array(phrases[:, i])) for i in range(phrases.shape[1])), b" ").to_pylist()
        counts.append(n)
    counts = np.concatenate(counts)
    # alike ones side by side pack better
    by = sorted(range(len(joined)), key=joined.__getitem__)
    rows = _deal(row["lang"], row["shard"], [joined[i] for i in by], counts[by], buckets) if by else []
    return _table(rows, _DEALT_TYPES)


def frequent_phrases(docs: DataFrame, keep: Callable[[DataFrame], DataFrame], text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100, shard_words: int = 1_000_000) -> DataFrame:
    """(lang, phrase, k, n, total): all words and phrases of up to `max_words` words with at least `min_count` occurrences; total counts the language's words. `keep` stores a table, see `scratch`."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    shards = keep(rows.mapInArrow(partial(_cut_shards, shard_words=shard_words), _SHARD_TYPES))
    totals = shards.groupBy("lang").agg(F.sum("n").alias("total")).filter("total > 0")
    sums = lambda dealt, answer: dealt.groupBy("bucket").applyInArrow(lambda bucket: _sum_words(bucket, min_count, answer), _FOUND_TYPES)

    buckets = _buckets(shards.agg(F.sum("many")).first()[0] or 0, WORDS)
    found = keep(sums(shards.filter("many > 0").select("lang", "shard", "words", "counts").mapInArrow(partial(_deal_words, buckets=buckets), _DEALT_TYPES), True))
    width = (found.agg(F.max("rank")).first()[0] or 0) + 1
    many = buckets * width
    if many >= 1 << 31:
        raise ValueError("more than 2^31 frequent words")
    words = found.filter("word is not null").select("lang", "word", "n", (F.col("bucket").cast("long") * width + F.col("rank")).alias("wid"))

    own = found.filter("shard is not null").select("shard", "bucket", "places", "ranks")
    texts = shards.select("shard", "lang", "words", "ids")
    paired = keep(own.groupBy("shard").cogroup(texts.groupBy("shard")).applyInArrow(_only_shards(partial(_pairs, buckets=buckets, width=width), _PAIR_TYPES), _PAIR_TYPES))

    pairs = paired.agg(F.sum("many")).first()[0] or 0
    parts = _buckets(pairs, PAIRS)
    dealt = paired.filter("many > 0").select("shard", "pairs", "counts").mapInArrow(partial(_deal_pairs, buckets=parts, bits=_bits(many)), _PART_TYPES)
    near = keep(dealt.groupBy("bucket").applyInArrow(lambda bucket: _sum_pairs(bucket, min_count), _NEAR_TYPES))

    texts = paired.select(F.col("shard").alias("shard"), "lang", "words", "wids", "ids")
    longer = near.filter("shard is not null").select("shard", "pairs").groupBy("shard").cogroup(texts.groupBy("shard"))
    longer = sums(longer.applyInArrow(_only_shards(partial(_longer, longest=max_words, many=many, buckets=_buckets(pairs, WORDS)), _DEALT_TYPES), _DEALT_TYPES), False)
    longer = longer.select("lang", F.col("word").alias("phrase"), F.size(F.split("word", " ")).alias("k"), "n")

    second = words.select(F.col("wid").alias("_b"), F.col("word").alias("_after"))
    two = near.filter("shard is null").select("pairs", "counts").mapInArrow(partial(_pair_rows, many=many), "wid long, _b long, n long")
    two = two.join(words.select("wid", "lang", "word"), "wid").join(second, "_b").select("lang", F.concat_ws(" ", "word", "_after").alias("phrase"), F.lit(2).alias("k"), "n")
    one = words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "n")
    return one.unionByName(two).unionByName(longer).join(totals, "lang")


_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[dict], types: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([(x.split()[0], _KINDS[x.split()[1]]) for x in types.split(", ")]))


def _table(rows: list[dict], types: str) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, types)])


def _only_shards(run, types: str):
    """`run` for keys that both sides have; a shard in which nothing is frequent gives no rows."""

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left, right) if left.num_rows and right.num_rows else _table([], types)

    return each


def score(frequent: DataFrame, keep: Callable[[DataFrame], DataFrame], scale: int = 1000) -> DataFrame:
    """Phrases of two words and more with `l` and `r` of their lowest-scoring cut, the score, and the largest counts of extensions by one word."""
    frequent = keep(frequent)
    phrases = frequent.filter("k > 1").withColumn("words", F.split("phrase", " "))
    part = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    sides = [F.struct(part(F.lit(2), F.col("k") - 1).alias("phrase"), F.lit(True).alias("left")), F.struct(part(F.lit(1), F.col("k") - 1).alias("phrase"), F.lit(False).alias("left"))]
    grown = phrases.filter("k > 2").select("lang", "n", F.inline(F.array(*sides)))
    grown = grown.groupBy("lang", "phrase").agg(F.max(F.when(F.col("left"), F.col("n"))).alias("left_most"), F.max(F.when(~F.col("left"), F.col("n"))).alias("right_most"))

    cuts = phrases.select("lang", "phrase", "k", "words", F.col("n").alias("a"), "total", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    halves = cuts.select("lang", F.col("phrase").alias("_of"), "a", "total", "cut", F.inline(F.array(F.struct(part(F.lit(1), F.col("cut")).alias("phrase"), F.lit(0).alias("half")), F.struct(part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("phrase"), F.lit(1).alias("half")))))
    counted = halves.join(frequent.select("lang", "phrase", "n"), ["lang", "phrase"])
    both = counted.groupBy("lang", "_of", "a", "total", "cut").agg(F.max(F.when(F.col("half") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("half") == 1, F.col("n"))).alias("r"))
    exact = F.expr(f"cast(cast({scale} as decimal(6,0)) * cast(a as decimal(16,0)) * cast(total as decimal(16,0)) as decimal(38,0)) div cast(cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as decimal(38,0))")
    lowest = both.withColumn("score", exact).groupBy("lang", "_of", "a", "total").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"))
    scored = lowest.select("lang", F.col("_of").alias("phrase"), "a", "s.l", "s.r", F.col("total").alias("n"), F.col("s.score").cast("long").alias("score"))
    return scored.join(grown, ["lang", "phrase"], "left")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100, first: int | None = 2000, shard_words: int = 1_000_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, left_most, right_most): each language's first phrases that no longer one replaces."""
    with scratch(docs.sparkSession) as keep:
        scored = score(frequent_phrases(docs, keep, text_col, lang_col, max_words, min_count, shard_words), keep)
        own = scored.filter(F.greatest(F.coalesce("left_most", F.lit(0)), F.coalesce("right_most", F.lit(0))) < F.col("a"))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = own.withColumn("rank", F.row_number().over(order).cast("long"))
        ranked = ranked.filter(F.col("rank") <= first) if first else ranked
        return materialise(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_most", "right_most"))
