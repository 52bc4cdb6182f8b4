"""BPE codec, packing and section counts against the tokenizer libraries."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortspan.llm import bpe_codec, packing, pretokens, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ENC = pretokens.load_encoding(RANKS)


def ids(text):
    return ENC.encode_ordinary(text or "")


def test_words_match_the_library_on_random_text():
    random.seed(2)
    alphabet = "ab1 2 \n\t\r'stmdrevlLL'''  é中͸!?  \U0001f600"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randrange(40))) for _ in range(4000)] + ["", "   ", "a" * 50]
    assert [x.tolist() for x in pretokens.WordEncoder(RANKS).encode(texts)] == [ids(t) for t in texts]


def test_long_text_is_cut_safely(monkeypatch):
    monkeypatch.setattr(pretokens, "CHUNK", 50)
    random.seed(4)
    texts = ["".join(random.choice("ab  c\n'") for _ in range(n)) for n in (0, 49, 50, 51, 700)]
    assert [x.tolist() for x in pretokens.WordEncoder(RANKS).encode(texts)] == [ids(t) for t in texts]


def test_codec_round_trip(docs, rows):
    encoded = bpe_codec.decode(bpe_codec.encode(docs, RANKS, block_bytes=4000), RANKS).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in encoded) == Counter((d, tuple(ids(t)), (t or "").encode()) for d, t in rows)


def test_codec_in_one_pass(docs, rows, empty):
    got = bpe_codec.round_trip(docs, RANKS, block_bytes=4000, packed=True).collect()
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == Counter((d, np.array(ids(t), "<u4").tobytes(), (t or "").encode()) for d, t in rows)
    assert bpe_codec.round_trip(empty, RANKS).count() == 0


def test_codec_round_trip_of_shuffled_rows(docs, rows):
    """Rows that come out of a shuffle, in no fixed order: they are written once, so words and positions agree."""
    shuffled = docs.repartition(7).filter(F.rand() >= 0)
    got = bpe_codec.decode(bpe_codec.encode(shuffled, RANKS, block_bytes=500), RANKS).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == Counter((d, tuple(ids(t)), (t or "").encode()) for d, t in rows)


def test_each_distinct_word_is_encoded_once():
    class Counting:
        calls = Counter()

        def encode_ordinary(self, word):
            self.calls[word] += 1
            return [1]

    encoder = pretokens.WordEncoder(RANKS, cache=None)
    encoder.encoding = Counting()
    for _ in range(3):
        encoder.words([f"w{i}" for i in range(1000)] + ["x" * 500])
    assert set(Counting.calls.values()) == {1}


def test_decode_special_rows(spark):
    df = spark.createDataFrame([(1, None), (2, []), (None, [64]), (None, [64])], "doc_id long, ids array<int>")
    one = ENC.decode_single_token_bytes(64)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in bpe_codec.decode(df, RANKS).collect()) == Counter([(1, (), b""), (2, (), b""), (None, (64,), one), (None, (64,), one)])
    with pytest.raises(Exception, match="not in the token-byte table"):
        bpe_codec.decode(spark.createDataFrame([(1, [10_000_000])], "doc_id long, ids array<int>"), RANKS).collect()


def test_codec_empty(empty):
    assert bpe_codec.decode(bpe_codec.encode(empty, RANKS), RANKS).count() == 0


def test_packing(docs, rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    got = packing.pack(docs, RANKS, capacity=128).collect()
    want = Counter()
    for d, t in rows:
        full = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(full) % 128 or 128
        cuts = [0, *range(first, len(full) + 1, 128)]
        for k in range(len(cuts) - 1):
            own = full[cuts[k] : cuts[k + 1]]
            want[d, k, cuts[k], len(own), zlib.crc32(np.array(own, "<u4").tobytes()), tuple(own)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 128
    assert len(by) <= 1.05 * sum(r.length for r in got) / 128 + 1


def test_packing_empty(empty):
    assert packing.pack(empty, RANKS).count() == 0


def best(items, capacity):
    """Fewest bins, by trying all."""
    items = sorted(items, reverse=True)
    found = [len(items)]

    def go(i, rooms):
        if len(rooms) >= found[0]:
            return
        if i == len(items):
            found[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= items[i] and rooms[j] not in rooms[:j]:
                go(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1 :])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return found[0]


def test_reduction_keeps_an_optimum():
    random.seed(6)
    for _ in range(150):
        items = [random.randrange(1, 20) for _ in range(random.randrange(1, 9))]
        fixed, left = packing.reduce_by_dominance(Counter(items), 20)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert Counter(s for t, own in fixed for s in own for _ in range(t)) + Counter(rest) == Counter(items)
        assert all(sum(own) <= 20 for _, own in fixed)
        assert sum(t for t, _ in fixed) + (best(rest, 20) if rest else 0) == best(items, 20)
        packed = packing.plan(Counter(items), 20)
        assert Counter(s for t, own in packed for s in own for _ in range(t)) == Counter(items) and all(sum(own) <= 20 for _, own in packed)


def test_section_tokens(docs, rows):
    """Every row, repeated, null and long ones too, against an attribution byte by byte."""
    for rule in ("first", "most"):
        got = Counter((r.doc_id, r.section, r.start, r.end, r.n_tokens, r.doc_tokens) for r in token_counts.section_tokens(docs, RANKS, rule, lambda t: list(range(0, max(len(t), 1), 7))).collect())
        want = Counter()
        for d, t in rows:
            t, tokens, counts, at = t or "", ids(t), Counter(), 0
            owner = [i // 7 for i, c in enumerate(t) for _ in c.encode()]
            for i in tokens:
                own = owner[at : at + len(ENC.decode_single_token_bytes(i))]
                at += len(own)
                counts[own[0] if rule == "first" else min(set(own), key=lambda s: (-own.count(s), s))] += 1
            for k, s in enumerate(range(0, max(len(t), 1), 7)):
                want[d, k, s, min(s + 7, len(t)), counts[k], len(tokens)] += 1
        assert got == want


def test_section_tokens_empty(empty):
    assert token_counts.section_tokens(empty, RANKS).count() == 0
