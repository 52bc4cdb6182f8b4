"""Spelling variants and collocations against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortspan.llm import collocations, spelling

UP = str.maketrans(spelling.UPPER, spelling.LOWER)


def brute_vocabulary(rows, min_count):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n, ratio):
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] is not None else None) for w in n}


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(5)
    base = ["document", "Änderung", "mississippi", "straße", "naïvety", "x" * 70, "aaaaaa", "aaaaaaa", "abcdef×", "ÉCOLES"]
    letters = list("abcdemnsté÷ß")
    rows = [(None, "document documents"), (1, None), (2, ""), (3, "short abc 123 --- ..."), (4, "a" * 9000)] + [(4, "a" * 9000)] * 5
    for i in range(600):
        words = []
        for w in rng.choice(base, 40):
            for _ in range(int(rng.choice([0, 0, 0, 0, 1, 2]))):
                at, c = int(rng.integers(len(w))), str(rng.choice(letters))
                w = [w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :], w[:at] + c + w[at:]][int(rng.integers(3))]
            words.append(w)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("bits", [16, 1])
def test_variants(spark, noisy, bits):
    df = spark.createDataFrame(noisy, "doc_id long, text string").withColumn("word", spelling.F.lit("x")).repartition(5)
    vocabulary = spelling.vocabulary(df)
    found = spelling.variants(vocabulary, bits_per_word=bits).collect()  # with one bit a word nearly every edit passes the filters
    n = brute_vocabulary(noisy, 5)
    assert {r.word: r.n for r in found} == n
    expected = brute_variants(n, 5)
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert any(r[1] is not None and r[2] != r[1] for r in expected)  # chains of two steps are among them


def test_filters_have_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abcdefgh"), 9)) for _ in range(3000)})
    blocks = {9: 400}
    filters = {9: np.zeros((400, spelling.LANES), np.uint32)}
    for batch in spelling._set_bits([__import__("pyarrow").RecordBatch.from_arrays([__import__("pyarrow").array(words)], names=["w"])], blocks):
        block = batch.column(1).to_numpy()
        for lane in range(spelling.LANES):
            np.bitwise_or.at(filters[9][:, lane], block, batch.column(2 + lane).to_numpy().astype(np.uint32))
    assert len(spelling._passing(filters, spelling._hash(spelling._codes(words)), 9)) == len(words)
    other = sorted({"".join(rng.choice(list("ijklmnop"), 9)) for _ in range(3000)})
    assert len(spelling._passing(filters, spelling._hash(spelling._codes(other)), 9)) < 30


def test_variants_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(empty)).collect() == []


def brute_phrases(rows, longest):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f, total


def brute_mine(rows, min_count, first, longest=5):
    f, total = brute_phrases(rows, longest)
    out = set()
    for lang, n in f.items():
        cand = {p: a for p, a in n.items() if len(p) > 1 and a >= min_count}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and b >= a and inside(p, q) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * total[lang] // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p), n[p[:k]], n[p[k:]]))
        kept.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out |= {(lang, i, p, -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(kept[:first], 1)}
    return out


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(2)
    words = np.array(["The", "of", "new", "york", "city", "data", "é", "Straße", "x", "in", "spite", "a b"])
    rows = [("en", None), (None, ""), ("en", " \t.,;\n"), ("de", "one"), (None, "New York. New York!\tnew york" * 30), ("en", "in spite of the " * 400), ("zz", "ha " * 300)]
    for i in range(300):
        text = " ".join(str(rng.choice(["in spite of", "new york city", "new york"])) if rng.random() < 0.3 else str(w) + str(rng.choice(["", "", "", ".", ",", "\n"])) for w in rng.choice(words, 40, p=np.arange(12, 0, -1) / 78))
        rows.append((["en", "de", None][i % 3], text))
    return rows


@pytest.mark.parametrize("shard_words", [300, 1_000_000])
@pytest.mark.parametrize("min_count,longest", [(20, 5), (7, 3)])
def test_collocations(spark, prose, shard_words, min_count, longest):
    df = spark.createDataFrame(prose, "lang string, text string").withColumns({"n": collocations.F.lit(1), "phrase": collocations.F.lit("y")}).repartition(3)
    found = collocations.mine(df, max_words=longest, min_count=min_count, first=60, shard_words=shard_words).drop("left_most", "right_most").collect()
    expected = brute_mine(prose, min_count, 60, longest)
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


@pytest.mark.parametrize("few", [5, 1 << 14])
def test_collocations_keep_a_shard_in_a_row(spark, prose, monkeypatch, few):
    """A stored table has at most a row for each shard and bucket, never one for each word or pair of a shard; many buckets give the same phrases."""
    monkeypatch.setattr(collocations, "FEW", few)
    most = 1 if few > 1000 else collocations.TASKS
    df, kept = spark.createDataFrame(prose, "lang string, text string").repartition(3), []
    with collocations.scratch(spark) as keep:
        found = collocations.frequent_phrases(df, lambda x: kept.append(keep(x)) or kept[-1], min_count=7, shard_words=300).collect()
        of_shards = [x.filter("shard is not null").groupBy("shard").count() for x in kept if "shard" in x.columns]
        assert len(of_shards) >= 3 and all(0 < x.agg({"count": "max"}).first()[0] <= most for x in of_shards)
    f, total = brute_phrases(prose, 5)
    expected = {(lang, " ".join(p), len(p), a, total[lang]) for lang, n in f.items() for p, a in n.items() if a >= 7}
    assert len(found) == len(expected) and {(r.lang, r.phrase, r.k, r.n, r.total) for r in found} == expected


def test_packed_numbers_words_and_pairs():
    rng = np.random.default_rng(6)
    for many in (1, 2, 3, 1000, (1 << 31) - 1):
        first, second = rng.integers(0, many, (2, 500))
        mixed = collocations._mixed(first, second, many)
        assert int(mixed.max()) < 1 << collocations._bits(many)
        assert all(np.array_equal(x, y) for x, y in zip(collocations._unmixed(mixed, many), (first, second), strict=True))
        mixed.sort()
        assert np.array_equal(collocations._unpack_numbers(collocations._pack_numbers(mixed, True), True), mixed)
    for numbers in ([], [0], [0, 0, 255, 256, 2**40, 1]):
        assert collocations._unpack_numbers(collocations._pack_numbers(np.array(numbers, np.int64))).tolist() == numbers
    words = ["é".encode(), b"a\x00b", b"x" * 1000]
    assert collocations._unpack_words(collocations._pack_words(words)) == words
    order, start = collocations._by_bucket(words * 20, 7)
    assert sorted(order.tolist()) == list(range(60)) and start[0] == 0 and start[-1] == 60 and len(start) == 8


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(empty).collect() == []
    rare = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert collocations.mine(rare).collect() == []


def test_intervals_count_every_phrase():
    rng = np.random.default_rng(4)
    ids = collocations._tight(rng.integers(0, 6, 4000).astype(np.int32))
    for depth in (2, 3, 4, 5):
        for phrases, counts in collocations.phrases_of(ids, 1, depth):
            k = phrases.shape[1]
            plain = Counter(tuple(ids[i : i + k].tolist()) for i in range(len(ids) - k + 1) if (ids[i : i + k] > 0).all())
            assert dict(zip(map(tuple, phrases.tolist()), counts.tolist(), strict=True)) == plain


def test_exact_scores(spark):
    frequent = spark.createDataFrame([("en", "a", 1, 3 * 10**12, 10**15), ("en", "b", 1, 7 * 10**11, 10**15), ("en", "a b", 2, 6 * 10**11, 10**15)], "lang string, phrase string, k int, n long, total long")
    row = collocations.score(frequent, lambda df: df).first()
    assert row.score == 1000 * 6 * 10**11 * 10**15 // (3 * 10**12 * 7 * 10**11)


def test_slices_end_at_breaks():
    text = "ab cd. ef\tGH, " * 200_000
    parts = list(collocations._slices(text))
    assert len(parts) > 2 and b"".join(parts).split() == text.lower().replace(".", "\n").replace(",", "\n").encode().split()
