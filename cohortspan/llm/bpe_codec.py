"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding: texts are split in pre-tokens in blocks. A block's distinct words go to the words' buckets, where each distinct word of the
corpus is encoded once; the ids come back to the block, are joined to the block's list of word numbers by position, and give the
documents' ids again. Words and positions of a block travel packed (a row for each word and block, let alone for each position, is
several times the input), so a very frequent word costs one entry for each block.

Decoding: the distinct ids of some documents are rows that are joined with the token-byte table, which has a row for each rank and
is broadcast; the documents' positions follow as one row, and bytes are put where their ids stand. Nothing is shuffled.

Results for special cases: a null text counts as empty and gives no ids, null ids decode to no bytes, an id that the table does not
have is an error; repeated rows and null document ids are kept, each row with its own result; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .common import free_arrow, materialise, shuffle_partitions

#: UTF-8 bytes of text in a block, about: the memory that one block takes in a task follows from it.
BLOCK_BYTES = 8_000_000
#: Ids of the documents that are decoded together, about.
DECODE_IDS = 200_000
_ENTRY = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("entry", pa.binary())])


def _pack_numbers(*arrays: np.ndarray) -> bytes:
    """Arrays of small unsigned numbers, compressed: all low bytes first, then all second bytes, and so on."""
    sizes = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()
    planes = [np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for x in arrays]
    return zstandard.compress(sizes + b"".join(planes))


def _unpack_numbers(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    at, out = 4 + 4 * n, []
    for size in np.frombuffer(raw, "<u4", n, 4).tolist():
        planes = np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * size
    return out


def _pack_words(words: list[str]) -> bytes:
    return zstandard.compress(b"".join(len(b).to_bytes(4, "little") + b for b in map(str.encode, words)))


def _unpack_words(data: bytes) -> list[str]:
    raw, at, out = zstandard.decompress(data), 0, []
    while at < len(raw):
        end = at + 4 + int.from_bytes(raw[at : at + 4], "little")
        out.append(raw[at + 4 : end].decode())
        at = end
    return out


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, list, list[str]]]:
    """(block, document ids, texts); a block's number names its partition and its place there."""
    number, ids, texts, size = TaskContext.get().partitionId() << 24, [], [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(lengths.tolist()):
            size += n
            if size >= block_bytes or i + 1 == len(lengths):
                part = batch.slice(at, i + 1 - at)
                ids += part.column(0).to_pylist()
                texts += [t or "" for t in part.column(1).to_pylist()]
                at = i + 1
            if size >= block_bytes:
                yield number, ids, texts
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield number, ids, texts


def _numbered(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words as met, the number of the word at each position of the block, and each text's count of positions."""
    seen: dict[str, int] = {}
    found, counts = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for owners, parts in pretokens.chunks(texts):
        words, number, firsts, odd = pretokens.split(parts)
        own = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))[number]
        pieces = [np.array([seen.setdefault(parts[k], len(seen))]) if k in odd else own[firsts[k] : firsts[k + 1]] for k in range(len(parts))] if odd else [own]
        found += pieces
        np.add.at(counts, owners, [len(x) for x in pieces] if odd else np.diff(firsts))
    return list(seen), np.concatenate(found), counts


def _by_bucket(words: list[str], buckets: int) -> list[list[str]]:
    """Each bucket's words in order."""
    out: list[list[str]] = [[] for _ in range(buckets)]
    for word in words:
        out[zlib.crc32(word.encode()) % buckets].append(word)
    for own in out:
        own.sort()
    return out


def _distinct_words(batches: Iterator[pa.RecordBatch], block_bytes: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for block, _, texts in _blocks(batches, block_bytes):
        by_bucket = _by_bucket(_numbered(texts)[0], buckets)
        full = [b for b in range(buckets) if by_bucket[b]]
        if full:
            yield pa.RecordBatch.from_pydict({"block": [block] * len(full), "bucket": full, "entry": [_pack_words(by_bucket[b]) for b in full]}, _ENTRY)
        free_arrow()


def _positions(batches: Iterator[pa.RecordBatch], block_bytes: int, buckets: int, id_type: pa.DataType | None) -> Iterator[pa.RecordBatch]:
    for block, ids, texts in _blocks(batches, block_bytes):
        words, numbers, counts = _numbered(texts)
        index = {w: i for i, w in enumerate(words)}
        place = np.empty(len(words), np.int64)
        place[np.fromiter(map(index.__getitem__, chain.from_iterable(_by_bucket(words, buckets))), np.int64, len(words))] = np.arange(len(words))
        columns = [pa.array([block], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([counts.tolist()], pa.list_(pa.int32())), pa.array([_pack_numbers(place[numbers])], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "counts", "positions"])
        free_arrow()


def _encode_words(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    """All entries with a word reach this task: it is encoded once. What is kept grows with the distinct words of its buckets only."""
    encoder = pretokens.WordEncoder(ranks, cache=None)
    for batch in batches:
        entries = []
        for entry in batch.column(2):
            pieces = encoder.words(_unpack_words(entry.as_py()))
            counts = np.fromiter(map(len, pieces), np.uint32, len(pieces))
            entries.append(_pack_numbers(counts, np.fromiter(chain.from_iterable(pieces), np.uint32, int(counts.sum()))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entries, pa.binary())], schema=_ENTRY)


def _reassemble(key, blocks: pa.Table, replies: pa.Table) -> pa.Table:
    """Put the ids of each word where the word stands in the block's texts."""
    parts = [_unpack_numbers(e.as_py()) for e in replies.sort_by("bucket").column("entry")]
    lengths = np.concatenate([np.zeros(0, np.uint32), *(p[0] for p in parts)]).astype(np.int64)
    flat = np.concatenate([np.zeros(0, np.uint32), *(p[1] for p in parts)]).astype(np.int32)
    del parts
    numbers = _unpack_numbers(blocks.column("positions")[0].as_py())[0].astype(np.int64)
    values, before = pretokens.expand(flat, lengths, numbers)
    counts = np.array(blocks.column("counts")[0].as_py(), np.int64)
    offsets = before[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
    return pa.table([blocks.column("ids").combine_chunks().flatten(), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["id", "ids"])


def _blocks_and_replies(docs: DataFrame, ranks: str, id_col: str, text_col: str, block_bytes: int, stored: bool):
    n = shuffle_partitions(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    rows = rows if stored else materialise(rows)
    arrow_type = _arrow_type(rows, id_col)
    words = rows.mapInArrow(partial(_distinct_words, block_bytes=block_bytes, buckets=n), "block long, bucket int, entry binary")
    replies = words.repartition(n, "bucket").mapInArrow(partial(_encode_words, ranks=ranks), "block long, bucket int, entry binary")
    blocks = rows.mapInArrow(partial(_positions, block_bytes=block_bytes, buckets=n, id_type=arrow_type), f"block long, ids array<{id_type}>, counts array<int>, positions binary")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")), id_type


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, stored: bool = False) -> DataFrame:
    """(`id_col`, ids array<int>) for every row of `docs`. `ranks` is the path of a tiktoken rank file on every machine.

    Rows are read twice, once for words and once for positions, and must come in the same order: `docs` is written to the checkpoint
    folder first, unless it is `stored`, that is, read from files through narrow steps only.
    """
    met, id_type = _blocks_and_replies(docs, ranks, id_col, text_col, block_bytes, stored)
    return met.applyInArrow(_reassemble, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def token_bytes(spark, ranks: str) -> DataFrame:
    """The token-byte table (token int, bytes binary) of a rank file."""
    return spark.createDataFrame([(i, bytearray(b)) for b, i in pretokens.load_ranks(ranks).items()], "token int, bytes binary")


def _distinct_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For some documents at a time a row for each distinct id, in order, then one row with the documents' ids, counts and positions."""
    for batch in batches:
        counts = pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, lo = np.cumsum(counts), 0
        while lo < len(counts):
            hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + DECODE_IDS, side="right")), lo + 1)
            part = batch.slice(lo, hi - lo)
            tokens, places = np.unique(part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
            id_type = part.column(0).type
            for token, ids, own, at in ((tokens, None, None, None), (None, part.column(0).to_pylist(), counts[lo:hi], places.ravel())):
                n = 1 if token is None else len(token)
                if n:
                    columns = [pa.nulls(1, pa.int32()) if token is None else pa.array(token, pa.int32())]
                    columns += [pa.nulls(n, pa.list_(t)) if x is None else pa.array([x], pa.list_(t)) for x, t in ((ids, id_type), (own, pa.int32()), (at, pa.int32()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["token", "ids", "counts", "places"])
            lo = hi
        free_arrow()


def _put_back(batches: Iterator[pa.RecordBatch], packed: bool) -> Iterator[pa.RecordBatch]:
    tokens, data = [], []

    def documents(row: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts, places = (row.column(name).flatten() for name in ("ids", "counts", "places"))
        known = np.concatenate([np.zeros(0, np.int64), *tokens])
        lengths = np.array([len(x) for x in data], np.int64)
        places = places.to_numpy().astype(np.int64)
        bytes_, before = pretokens.expand(np.frombuffer(b"".join(data), np.uint8), lengths, places)
        offsets = np.concatenate([[0], np.cumsum(counts.to_numpy())])
        values = known[places]
        if packed:
            lists = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(values.astype("<u4"))])
        else:
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
        decoded = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(before[offsets].astype(np.int32)), pa.py_buffer(bytes_)])
        return pa.RecordBatch.from_arrays([ids, lists, decoded], names=["id", "ids", "decoded"])

    for batch in batches:
        last = batch.column("token").is_null().to_numpy(zero_copy_only=False)
        lo = 0
        for hi in [*np.flatnonzero(last).tolist(), batch.num_rows]:
            own = batch.slice(lo, hi - lo)
            tokens.append(own.column("token").to_numpy(zero_copy_only=False).astype(np.int64))
            found = own.column("bytes").to_pylist()
            if None in found:
                raise ValueError("an id is not in the token-byte table")
            data += found
            if hi < batch.num_rows:
                yield documents(batch.slice(hi, 1))
                tokens, data = [], []
            lo = hi + 1
    free_arrow()


def _with_bytes(grouped: DataFrame, ranks: str, id_col: str, id_type: str, packed: bool) -> DataFrame:
    # the table's side is broadcast (a row a rank), so rows are neither moved nor reordered
    joined = grouped.join(F.broadcast(token_bytes(grouped.sparkSession, ranks)), "token", "left").select("token", "ids", "counts", "places", "bytes")
    out = joined.mapInArrow(partial(_put_back, packed=packed), f"id {id_type}, ids {'binary' if packed else 'array<int>'}, decoded binary")
    return out.withColumnRenamed("id", id_col)


def _grouped_schema(id_type: str) -> str:
    return f"token int, ids array<{id_type}>, counts array<int>, places array<int>"


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", packed: bool = False) -> DataFrame:
    """(`id_col`, ids, decoded binary) for every row of `encoded`: each id joined with its bytes, by position.

    With `packed`, ids come back as little-endian unsigned 32-bit numbers in a row (binary).
    """
    id_type = encoded.schema[id_col].dataType.simpleString()
    grouped = encoded.select(F.col(id_col), "ids").mapInArrow(_distinct_ids, _grouped_schema(id_type))
    return _with_bytes(grouped, ranks, id_col, id_type, packed)


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, stored: bool = False, packed: bool = False) -> DataFrame:
    """`decode(encode(docs))`, with the ids grouped for decoding in the task that puts them together."""
    met, id_type = _blocks_and_replies(docs, ranks, id_col, text_col, block_bytes, stored)

    def both(key, blocks: pa.Table, replies: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(_distinct_ids(_reassemble(key, blocks, replies).combine_chunks().to_batches())))

    return _with_bytes(met.applyInArrow(both, _grouped_schema(id_type)), ranks, id_col, id_type, packed)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return df.sparkSession.createDataFrame([], df.select(name).schema).toArrow().schema.field(0).type
