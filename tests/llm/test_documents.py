"""Language ID, quality, SimHash, personal data and sharding on small documents, against brute force."""

import hashlib
import math
import pickle
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortspan.llm import pii, ppm_langid, quality, sharding, simhash
from cohortspan.llm.common import number_within

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def learned(texts):
    """A model of the texts of each language, and the plain trees: how often each byte followed each context."""
    counts, grams = {k: {} for k in texts}, []
    for lang, own in texts.items():
        for t in own:
            padded = bytes(3) + t
            for i in range(3, len(padded)):
                for d in range(4):
                    c = counts[lang].setdefault(padded[i - d : i], Counter())
                    c[padded[i]] += 1
            grams += [(lang, int(g)) for g in ppm_langid._grams(t)]
    table = sorted(Counter(grams).items())
    langs = sorted(texts)
    model = pickle.dumps((langs, np.array([langs.index(k[0]) for k, _ in table], np.uint8), np.array([k[1] for k, _ in table], np.uint32), np.array([n for _, n in table], np.uint32)))
    return model, counts


def plain_cost(counts, lang, text):
    def p(context, sym):
        if context is None:
            return 1 / 256
        c = counts[lang].get(context)
        shorter = context[1:] if context else None
        if c is None:
            return p(shorter, sym)
        all_ = sum(c.values()) + len(c)
        return c[sym] / all_ if sym in c else len(c) / all_ * p(shorter, sym)

    padded = bytes(3) + text
    return sum(np.log(p(padded[i - 3 : i], padded[i])) for i in range(3, len(padded)))


def test_ppm_costs_against_plain_trees(monkeypatch):
    model, counts = learned({"x": [b"abracadabra", b"cab"], "y": [b"banana band", b"nab"]})
    tests = [b"abra", b"banana", b"", b"zq cab", b"nabab dab", "zé a\u4e2d".encode(), b"abracadabra banana band " * 20]
    want = [[plain_cost(counts, lang, t) for lang in ("x", "y")] for t in tests]
    assert ppm_langid.Trees(model).costs(tests) == pytest.approx(np.array(want), rel=1e-9)
    monkeypatch.setattr(ppm_langid, "WINDOW", 7)  # long texts are scored in parts
    assert ppm_langid.Trees(model).costs(tests) == pytest.approx(np.array(want), rel=1e-9)


def test_ppm_keeps_every_context():
    """Far more than 16,384 contexts in three languages: costs are those of the plain trees."""
    rng = np.random.default_rng(2)
    texts = {lang: [bytes(rng.integers(lo, lo + 60, 30_000, dtype=np.uint8)) for lo in (40, 150)] for lang in "xyz"}
    model, counts = learned(texts)
    assert len({c for own in counts.values() for c in own if len(c) == 3}) > 100_000
    tests = [t[i : i + 50] for own in texts.values() for t in own for i in (0, 777)] + [b"nothing learned \xff\xfe"]
    want = [[plain_cost(counts, lang, t) for lang in "xyz"] for t in tests]
    assert ppm_langid.Trees(model).costs(tests) == pytest.approx(np.array(want), rel=1e-9)


def test_language_ties_and_repeated_rows(spark):
    """Two languages learned from equal texts tie: the first by name wins. A row repeated often counts once in learning."""
    rows = [(i, f"same text {i % 7}", lang) for i, lang in enumerate(["b", "a"] * 40)]
    rows = [(i, f"same text {i // 2 % 7}", lang) for i, _, lang in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = df.filter("doc_id < 28")
    got = ppm_langid.predict(df, ppm_langid.learn(sample), ["doc_id"]).collect()
    assert {(r.lang_pred, round(r.score, 9)) for r in got} == {("a", 0.5)}
    often = sample.union(spark.range(500).selectExpr("4L", "'same text 2'", "'b'"))
    assert pickle.loads(ppm_langid.learn(often))[3].tolist() == pickle.loads(ppm_langid.learn(sample))[3].tolist()


def test_language_rows(spark, docs, empty):
    en, de = "the of and to in is that it", "der die das und ist nicht ein zu"
    rows = [(i, " ".join(np.random.default_rng(i).choice((en if i % 2 else de).split(), 30)), "en" if i % 2 else "de") for i in range(200)]
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "123 !!", "de"), (902, "", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in ppm_langid.identify(df).collect()}
    assert all(got[i][0] == lang for i, _, lang in rows) and got[900] == got[901] == got[902] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got.values())
    assert ppm_langid.identify(docs).count() == docs.count() and ppm_langid.identify(empty).count() == 0
    assert {r.lang_pred for r in ppm_langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_texts_of_no_learned_language(spark):
    """Foreign scripts and noise are coded worse than plain bytes; documents of a learned language and short texts pass."""
    rng = np.random.default_rng(11)
    words = {"en": "the cat sat on a mat and the dog ran home".split(), "de": "der hund und die katze liefen nach hause".split()}
    learned = [(i, " ".join(rng.choice(words[lang], 40)), lang) for i, lang in enumerate(["en", "de"] * 20)]
    sample = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    noise = "".join(chr(c) for c in rng.integers(0x410, 0x450, 600))
    texts = ["the dog sat home " * 30, "die katze und der hund " * 30, noise, noise[:9], "zq%7#" * 200, None, "", "cat"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ppm_langid.predict(df, ppm_langid.learn(sample), ["doc_id", "text"]).withColumn("ok", ppm_langid.plausible())
    assert [r.ok for r in got.orderBy("doc_id").collect()] == [True, True, False, True, False, None, None, True]
    plain = ppm_langid.Trees(ppm_langid.learn(sample))
    for r in got.filter("bits is not null").collect():
        cost = -plain.costs([r.text.encode()])[0, plain.langs.index(r.lang_pred)] / np.log(2)
        assert r.bits * len(r.text.encode()) == pytest.approx(cost) and r.ok == (cost <= 8 * len(r.text.encode()) + ppm_langid.SLACK)


def test_quality(spark, docs, empty):
    rng = np.random.default_rng(1)
    good, bad = "clear careful useful text about plants and rivers".split(), "buy!! now$$ click### win%%% cheap***".split()
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad, 25))) for i in range(400)]
    df = spark.createDataFrame([*rows, (1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 400)] + [(7, None), (8, 5), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: (r.score, r.predicted) for r in quality.classify(df, labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i][1] == int(i % 3 > 0) for i in held]) > 0.97
    assert 0 <= got[1000][0] <= 1 and got[1000] == got[1001] and all(p == int(s >= 0.7) for s, p in got.values())
    none = quality.classify(docs, labels.limit(0))
    assert none.count() == docs.count() and {r.score for r in none.collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0


def plain_features(text):
    """Words, a mark for each word that repeats the one before it, and character n-grams of marked words."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [f"<{w}>"[i : i + n] for n in (3, 4) for w in words for i in range(len(w) + 3 - n)]
    return words, grams, sum(a == b for a, b in zip(words, words[1:]))


def test_quality_features():
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(["a", "b", "é", "\U0001f600", " ", "\n", "\u2003"], rng.integers(0, 30))) for _ in range(300)] + ["x y z " * 50_000]
    bucket = {}
    for t in texts:
        words, grams, repeated = plain_features(t)
        own = quality.features(t).tolist()
        assert own[:repeated] == [quality.REPEATED] * repeated and len(own) == repeated + len(words) + len(grams)
        for key, b in zip([("w", w) for w in words], own[repeated:], strict=False):
            assert bucket.setdefault(key, b) == b
        rest = Counter(own[repeated + len(words) :])
        if len(t) < 40:
            for n in set(grams):
                alone = [quality.features(n[1:-1])] if n[0] == "<" and n[-1] == ">" else []
                assert all(set(a.tolist()) <= set(own) for a in alone)
        assert sum(rest.values()) == len(grams)
    assert len(set(bucket.values())) > 0.9 * len(bucket)


def test_quality_training_against_plain_gradients(monkeypatch):
    """One epoch over explicit vectors with the gradient of the softmax loss, by numerical differences."""
    monkeypatch.setattr(quality, "BUCKETS", 50)
    texts, labels = ["a b", "b c c", "d", ""], np.array([1, 0, 1, 0])
    dims, rate, seed = 3, 0.3, 5
    rng = np.random.default_rng(seed)
    v, o, b = rng.normal(0, 0.1, (50, dims)), rng.normal(0, 0.1, (2, dims)), np.zeros(2)
    sv, so, sb = np.full(50, 1e-8), 1e-8, 1e-8

    def loss(v, o, b, share, label):
        z = o @ (share @ v) + b
        return -z[label] + np.log(np.exp(z).sum())

    def slope(x, f):
        out = np.zeros_like(x)
        for i in np.ndindex(x.shape):
            up, down = x.copy(), x.copy()
            up[i] += 1e-6
            down[i] -= 1e-6
            out[i] = (f(up) - f(down)) / 2e-6
        return out

    for i in rng.permutation(4):
        f = quality.features(texts[i])
        share = np.bincount(f, minlength=50) / max(len(f), 1)
        gv, go, gb = slope(v, lambda x: loss(x, o, b, share, labels[i])), slope(o, lambda x: loss(v, x, b, share, labels[i])), slope(b, lambda x: loss(v, o, x, share, labels[i]))
        so, sb, sv = so + (go**2).sum(), sb + (gb**2).sum(), sv + (gv**2).sum(axis=1)
        o, b = o - rate * go / np.sqrt(so), b - rate * gb / np.sqrt(sb)
        v = v - rate * gv / np.sqrt(sv)[:, None]
    want = np.concatenate([[b[1] - b[0]], v @ (o[1] - o[0])])
    assert quality.train(texts, labels, dims=dims, epochs=1, rate=rate, seed=seed) == pytest.approx(want, abs=1e-4)


def test_quality_threshold_and_repeated_ids(spark):
    """A score of exactly the threshold counts as good; repeated rows of an id count once in training."""
    model = np.zeros(1 + quality.BUCKETS)
    df = spark.createDataFrame([(i, f"word {i % 5} " * (1 + i % 3)) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    assert {r.score for r in quality.score(df, model, ["doc_id"]).collect()} == {0.5}
    assert {r.predicted for r in quality.classify(df, labels.limit(0), threshold=0.5).collect()} == {1}
    often = df.union(spark.range(300).selectExpr("4L", "'word 4 word 4 '"))
    assert quality.learn(often, labels).tolist() == quality.learn(df, labels).tolist()
    assert len({r.score for r in quality.classify(often, labels).filter("doc_id = 4").collect()}) == 1


def test_quality_never_sees_held_out_labels(spark):
    df = spark.createDataFrame([(i, f"word{i % 7} other") for i in range(200)], "doc_id long, text string")
    a = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    b = spark.createDataFrame([(i, 1 - i % 2 if zlib.crc32(str(i).encode()) % 4 == 2 else i % 2) for i in range(200)], "doc_id long, quality int")
    assert sorted(quality.classify(df, a).collect()) == sorted(quality.classify(df, b).collect())


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """Component of each fingerprint (an index into a list of distinct ones) by all pairs."""
    a = np.array(sorted(set(fps)), np.uint64)
    root = list(range(len(a)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 3):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return {int(v): find(i) for i, v in enumerate(a)}


def test_simhash_classes(docs, rows, empty):
    got = simhash.classes(docs).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = classes(fps)
    least = {}
    for (d, _), f in zip(rows, fps, strict=True):
        if d is not None:
            least[comp[f]] = min(d, least.get(comp[f], d))
    want = Counter((d, f - (1 << 64) if f >> 63 else f, least.get(comp[f])) for (d, _), f in zip(rows, fps, strict=True))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got) == want
    assert simhash.classes(empty).count() == 0
    assert simhash.keep_one(docs).filter("doc_id is null").count() == 1


def test_one_row_of_each_component_stays(spark, docs, rows):
    """Also of repeated rows, of different texts that share an id, and of rows without an id."""
    t, u = "one two three four five six", "seven eight nine ten"
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, t), (2, t), (3, u), (1, u), (None, "alone"), (None, "alone"), (None, None), (9, "")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(df).collect()), key=str) == sorted([(1, t), (1, u), (9, ""), (None, "alone")], key=str)
    kept = simhash.keep_one(docs)
    comp = classes([plain_fingerprint(t) for _, t in rows])
    assert kept.columns == docs.columns
    assert Counter(comp[plain_fingerprint(r.text)] for r in kept.collect()) == Counter(set(comp.values()))


def test_links_connect_what_pairs_connect(spark):
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = set()
    for c in centres:
        for _ in range(25):
            v = int(c)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                v ^= 1 << int(b)
            fps.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in fps]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    mask = (1 << 64) - 1
    assert all(((e.a ^ e.b) & mask).bit_count() <= 3 for e in edges)
    root = {v & mask: v & mask for v in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for e in edges:
        root[find(e.a & mask)] = find(e.b & mask)
    comp = classes(fps)
    assert len({find(v) for v in fps}) == len(set(comp.values()))


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), i, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_base_spans_on_random_text(spark):
    rng = np.random.default_rng(8)
    parts = ["a", "B.", "@", "@x", ".y", "1", "25", "255", ".", "-", " ", "4111111111111111", "4111 1111-1111 1111", "+", "+4", "(0)", "_", "%", "é", "\U0001f600", "300", "a@b.c", "1.2.3.4", "\n", "00"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.s for r in df.select("doc_id", pii.describe(pii.base_spans(F.col("text"))).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_spans(t) for t in texts]


def test_disclosing_terms(spark, docs, rows, empty):
    data = [(i, f"Filler {i} text write to our {'zanzibar' if i % 2 else 'harbour zanzibar'} office at bob{i % 2}@corp.example today {'abcdefghij'[i] * 3} ok") for i in range(8)]
    data += [(100 + i, f"plain the office text {i} our today write to zanzibar ok") for i in range(200)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert all("harbour" not in found[i].pii_text and "<EMAIL>" in found[i].pii_text and "zanzibar" in found[i].pii_text for i in (0, 2, 4, 6))
    assert all(found[i].pii_text == t for i, t in data if i >= 100)
    got = pii.find(docs).select("doc_id", "text", "fp", "pii_text", pii.describe(F.col("pii_base")).alias("s")).collect()
    assert Counter((r.doc_id, r.s) for r in got) == Counter((d, plain_spans(t)) for d, t in rows)
    assert all((r.pii_text is None) == (r.text is None) and (r.s or r.pii_text == r.text) for r in got)
    assert pii.find(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(pii.describe(F.array().cast(pii._SPAN)), 256)).first()[0]


def test_copies_do_not_hide_disclosing_terms(spark):
    data = [(i, f"Case {'abc'[i] * 3} write to our harbour office at bob@corp.example today") for i in range(3)]
    data += [(100 + i, f"plain the office text {i} our today write to zanzibar ok") for i in range(300)]
    copies = [(1000 + i, data[0][1]) for i in range(1000)]

    def texts(rows):
        return {r.doc_id: r.pii_text for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    once, often = texts(data), texts(data + copies)
    assert all("harbour" not in once[i] for i in range(3))
    assert all(often[i] == t for i, t in once.items()) and all(often[i] == once[0] for i, _ in copies)


def test_disclosing_terms_of_whole_texts(spark):
    """Two texts are enough, the name stands far from the value, and what chance explains stays."""
    far = " ".join(f"word{i}" for i in range(40))
    data = [(i, f"Harbour {far} case {'ab'[i] * 3} write to bob@corp.example") for i in range(2)] + [(2, f"lonely {far} ccc ann@corp.example")]
    data += [(100 + i, f"plain {far} case {i} write bob to corp") for i in range(400)]
    found = {r.doc_id: r.pii_text for r in pii.find(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert all(found[i] == f" {far} case {'ab'[i] * 3} write to <EMAIL>" for i in range(2))
    assert found[2] == f"lonely {far} ccc <EMAIL>" and all(found[i] == t for i, t in data if i >= 100)
    every = pii.find(spark.createDataFrame([(i, f"text {i} bob@corp.example") for i in range(4)], "doc_id long, text string"))
    assert [r.pii_text for r in every.orderBy("doc_id").collect()] == [f"text {i} <EMAIL>" for i in range(4)]


def test_many_matches_in_one_text(spark):
    n = 50_000
    text = " ".join(f"word{i} u{i}@corp.example 10.0.{i % 250}.{i % 256}" for i in range(n))
    df = spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string").repartition(1).cache()
    df.count()
    start = time.time()
    got = {r.doc_id: r.s for r in df.select("doc_id", pii.base_spans(F.col("text")).alias("s")).collect()}
    took = time.time() - start
    assert [(s.kind, s.value) for s in got[1][:4]] == [("email", "u0@corp.example"), ("ip", "10.0.0.0"), ("email", "u1@corp.example"), ("ip", "10.0.1.1")]
    assert len(got[1]) == 2 * n and all(text[s.start : s.end] == s.value for s in got[1]) and got[2] == [] and took < 60
    start = time.time()
    found = {r.doc_id: r.pii_text for r in pii.find(df).select("doc_id", "pii_text").collect()}
    assert found == {1: " ".join(f"word{i} <EMAIL> <IP>" for i in range(n)), 2: "none"} and time.time() - start < 120


def test_ids_do_not_matter(spark):
    data = [f"Filler {i} text write to our {'harbour' if i % 2 else 'zanzibar'} office at bob{i % 2}@corp.example today {'abcdefghij'[i] * 3} ok" for i in range(8)] + [f"plain the office text {i} our today write ok" for i in range(200)]
    texts = lambda ids: sorted(r.pii_text for r in pii.find(spark.createDataFrame([(i, t) for i, t in zip(ids, data)], "doc_id long, text string")).collect())
    own = texts(range(208))
    assert sum("harbour" in t for t in own) == 0 and texts([None] * 208) == own and texts([7] * 208) == own


def brute_terms(texts, generalise, remove, alpha):
    """The docstring's rule over distinct texts, by plain counting."""
    distinct = sorted(set(texts))
    entities, words = [], []
    for t in distinct:
        spans = [x.split(":") for x in plain_spans(t).split(",") if x]
        entities.append({f"{k}:{t[int(a) : int(b)].lower()}" for k, a, b in spans})
        rest, at = "", 0
        for _, a, b in spans:
            rest, at = rest + t[at : int(a)] + " ", max(at, int(b))
        words.append(set(re.findall(r"[^\W\d_][^\W_]{2,}", (rest + t[at:]).lower())))
    every = len(distinct)
    n_entity, n_word = Counter(e for es in entities for e in es), Counter(w for ws in words for w in ws)
    n_both = Counter((e, w) for es, ws in zip(entities, words) for e in es for w in ws)
    needed = math.log(len(n_entity) * len(n_word) / alpha)
    out = set()
    for (e, w), both in n_both.items():
        gain, whole = math.log(both * every / (n_entity[e] * n_word[w])), math.log(every / n_entity[e])
        nats = both * gain + ((n_entity[e] - both) * (math.log(1 - both / n_entity[e]) - math.log(1 - n_word[w] / every)) if both < n_entity[e] else 0)
        if gain >= generalise * whole and nats >= needed:
            out.add((e, w, gain >= remove * whole))
    return out


@pytest.mark.parametrize("generalise,remove", [(0.9, 0.97), (0.5, 0.9), (1.0, 1.0)])
def test_terms_against_plain_counts(spark, generalise, remove):
    rng = np.random.default_rng(12)
    names = ["harbour", "station", "library", "market"]
    texts = []
    for i in range(400):
        k = int(rng.integers(4))
        shown = names[k] if rng.random() < (1.0, 0.95, 0.8, 0.6)[k] else names[(k + 1) % 4]
        value = f" at user{k}@corp.example" if rng.random() < 0.15 else ""
        texts.append(f"text {i} about {shown if value or rng.random() < 0.02 else 'nothing'} and {rng.choice(WORDS)}{value}")
    rows = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("hash", F.md5("text")).withColumn("base", pii.base_spans(F.col("text")))
    mentions = rows.filter(F.size("base") > 0).select("hash", F.array_distinct(F.transform("base", pii._entity)).alias("entities"), pii._terms(F.lower(pii._replaced(F.col("text"), F.col("base"), lambda s: F.lit(" ")))).alias("terms"))
    got = {tuple(r) for r in pii.revealing_terms(rows, mentions, generalise, remove, 0.05).collect()}
    expected = brute_terms(texts, generalise, remove, 0.05)
    assert got == expected and (got or generalise == 1.0)


def test_shards(spark, docs, rows, empty):
    got = sharding.shard(docs).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    assert sharding.shard(empty).count() == 0
    hot = spark.createDataFrame([(i, "same text" if i % 3 == 0 else f"text number {i} " + "x" * (i % 50)) for i in range(6000)], "doc_id long, text string")
    sizes = [r.b for r in sharding.shard(hot).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 24 and max(sizes) <= 1.03 * min(sizes)
    small = sharding.shard(hot.filter("doc_id < 300")).groupBy("text_crc32").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count()
    assert small <= 1  # only the group with a third of all rows is cut


def test_shards_of_rows_that_are_alike(spark):
    """Repeated rows without an id can't be told apart by what they hold, and still fill the shards evenly."""
    df = spark.range(3500).selectExpr("if(id < 3000, null, id) doc_id", "if(id < 3000, 'the same', concat('text ', id)) text")
    got = sharding.shard(df).collect()
    sizes, slots = Counter(), {}
    for r in got:
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 3500 and len(sizes) == 24 and max(sizes.values()) <= 1.03 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_placing_against_plain_dot_products():
    """Largest first; among shards with room for the bytes the one with the highest dot product, ties to the lower number. Exact fractions."""
    rng = np.random.default_rng(7)
    for n, shards, tasks in ((0, 3, 1), (1, 3, 1), (40, 4, 1), (60, 7, 3), (200, 24, 2)):
        items = [tuple(map(int, x)) for x in rng.integers(0, 9, (n, 3))]
        total = [max(sum(x), 1) for x in zip(*items)] if n else [1, 1, 1]
        need = [[Fraction(c * shards * tasks, t) for c, t in zip(row, total)] for row in items]
        room, want = [[Fraction(1)] * 3 for _ in range(shards)], [0] * n
        for i in sorted(range(n), key=lambda i: -max(need[i])):
            fit = [s for s in range(shards) if room[s][0] >= need[i][0]]
            dot = lambda s: sum(a * b for a, b in zip(room[s], need[i]))
            want[i] = max(fit, key=lambda s: (dot(s), -s)) if fit else max(range(shards), key=lambda s: (room[s][0], -s))
            room[want[i]] = [a - b for a, b in zip(room[want[i]], need[i])]
        left = [list(total) for _ in range(shards)]
        assert sharding.place(items, left, total, tasks) == want
        assert [[Fraction(x, t) for x, t in zip(r, total)] for r in left] == room


def test_shards_placed_by_many_tasks(spark, monkeypatch):
    """The same balance where groups are dealt to several tasks, and no group but the largest in two shards."""
    monkeypatch.setattr(sharding, "TASK_GROUPS", 400)
    df = spark.range(4000).selectExpr("id doc_id", "concat('text ', id % 3500, repeat(' w', int(id % 40)), repeat('x', int(id * id % 300))) text")
    got = sharding.shard(df).groupBy("shard").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    sizes, rows = [r.b for r in got], [r.n for r in got]
    assert len(got) == 24 and max(sizes) <= 1.03 * min(sizes) and max(rows) <= 1.2 * min(rows)
    assert sharding.shard(df).groupBy("text_crc32").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count() == 0


def test_numbers_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.lit(1).alias("id"))  # rows are alike
    got = number_within(df, "g", "n").groupBy("g").agg(F.count_distinct("n").alias("c"), F.max("n").alias("m"), F.min("n").alias("l"), F.count(F.lit(1)).alias("k")).collect()
    assert all((r.c, r.m, r.l) == (r.k, r.k - 1, 0) for r in got)
