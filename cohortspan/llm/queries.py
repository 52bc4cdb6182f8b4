"""Queries of the operators, as registered by the entry module: each turns an operator's output into digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, bpe_codec, collocations, html_crf, learned_partitions, packing, pii, ppm_langid, quality, sharding, simhash, spelling, token_counts
from .common import held_out

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_codec.round_trip(table(spark, sf_dir, "documents"), RANKS, stored=True, packed=True)
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ppm_langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), RANKS, keep_ids=False)


def op6_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), RANKS)


def op7_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_kind(F.col("pii_base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.describe(F.col("pii_base")), 256).alias("base_sha256"), pii.describe(F.col("pii_spans")).alias("spans"))


def op8_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_ball_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_bloom_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op12_fm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.learn(pages), ["page_id", "url"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ball_tree, op2_learned_partitions, op3_bpe_codec, op4_ppm_language, op5_best_fit_packing, op6_section_tokens, op7_disclosure_pii, op8_subword_quality, op9_ball_simhash, op10_vector_sharding, op11_bloom_spelling, op12_fm_collocations, op13_crf_extraction)}


#: All pairs of query and candidate rows; sums of these integers stay below 2^53, so the double inner product is exact.
OP1_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vec, row_number() OVER () AS nth FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.nth, q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
  FROM usable q JOIN usable c ON q.nth <> c.nth AND len(q.vec) = len(c.vec) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY nth ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 bit by bit over the UTF-8 bytes; near words meet on what is left when a code point is taken out.
OP11_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(flatten(list_transform(string_split(named, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)),
    lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)), 4294967295::BIGINT), 4294967295) AS h FROM runs),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
without AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM without a JOIN words b ON a.rest = b.word),
best AS (SELECT p.word, count(*) AS n_near, arg_min(p.near, (-w.n, p.near)) AS near, max(w.n) AS near_n FROM pairs p JOIN words w ON w.word = p.near GROUP BY 1),
found AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (SELECT word, word AS at FROM found UNION ALL SELECT walk.word, found.form FROM walk JOIN found ON found.word = walk.at WHERE found.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN found ON found.word = walk.at WHERE found.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM found f JOIN ends e ON e.word = f.word
"""

#: All phrases of up to five words, the literal rule of containment, integers of 128 bits.
OP12_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words WHERE len(ws) > 0),
grams AS (SELECT lang, list_slice(ws, i, i + k - 1) AS p FROM starts, range(1, 6) t(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, p, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY 1),
candidates AS (SELECT lang, p, a FROM f WHERE len(p) > 1 AND a >= 100),
inside AS (SELECT lang, list_slice(p, i, j) AS q, max(a) AS a FROM (SELECT lang, p, a, i, unnest(range(i + 1, len(p) + 1)) AS j FROM (SELECT *, unnest(range(1, len(p))) AS i FROM candidates)) WHERE j - i + 1 < len(p) GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN inside i ON i.lang = c.lang AND i.q = c.p WHERE coalesce(i.a, 0) < c.a),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM kept),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, l.a AS l, r.a AS r, t.n, ((1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, c.k) JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, c.k + 1, len(c.p))),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator: exact search, spelling variants, collocations. Token ids, fingerprints, trained models and placement have none."""
    return {"op1_ball_tree": OP1_SQL, "op11_bloom_spelling": OP11_SQL, "op12_fm_collocations": OP12_SQL}
