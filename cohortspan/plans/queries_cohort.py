"""Queries on reads, people, metrics, sequences, samples and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import alignments as A
from ..operators import annotate, checks, cohort, compare, evidence, stats
from ..streaming import metrics as streaming
from .registry import Tables, query

KEYS = ["sample_id", "target"]
TOTALS = "tot AS (SELECT sample_id, target, COUNT(*) + 5 AS input_reads, (COUNT(*) + 5) * 150 AS input_bases FROM gaf GROUP BY 1, 2)"


def totals(t: Tables) -> DataFrame:
    return t.gaf.groupBy(*KEYS).agg((F.count(F.lit(1)) + 5).alias("input_reads"), ((F.count(F.lit(1)) + 5) * 150).alias("input_bases"))


# reads on graphs


@query("scl_17_fragment_names", "SELECT read_name, string_split(read_name, '/')[1] AS fragment FROM gaf", ("gaf",))
def _(t):
    return t.gaf.select("read_name", C.fragment_name(F.col("read_name")).alias("fragment"))


TOKENS = "tk AS (SELECT *, regexp_extract_all(path, '[><][^><]+') AS k FROM gaf)"
FLIP = "translate(substr({0}, 1, 1), '><', '<>') || substr({0}, 2)"


@query("scl_18_canonical_edges", f"+ {TOKENS}, e AS (SELECT unnest([k[1] || k[2], k[2] || k[3]]) AS edge, unnest([{FLIP.format('k[2]')} || {FLIP.format('k[1]')}, {FLIP.format('k[3]')} || {FLIP.format('k[2]')}]) AS back FROM tk) SELECT least(edge, back) AS edge, COUNT(*) AS traversals FROM e GROUP BY 1", ("gaf",))
def _(t):
    edges = t.gaf.select(F.explode(C.path_edges(C.path_tokens(F.col("path")))).alias("e"))
    return edges.groupBy(C.canonical_edge(F.col("e")).alias("edge")).agg(F.count(F.lit(1)).alias("traversals"))


@query("scl_19_canonical_traversal", f"+ {TOKENS} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN path ELSE {FLIP.format('k[3]')} || {FLIP.format('k[2]')} || {FLIP.format('k[1]')} END AS path FROM tk", ("gaf",))
def _(t):
    return t.gaf.select("event_id", C.canonical_traversal(F.col("path"), F.when(F.col("event_id") % 2 == 0, "+").otherwise("-")).alias("path"))


MAPPED = "CASE WHEN NOT is_secondary AND mapq < 255 THEN mapq END"


@query(
    "agg_9_mapping_metrics_input",
    f"""+ {TOTALS}, g AS (SELECT sample_id, target, COUNT(*) FILTER (NOT is_secondary) AS p, COUNT(*) FILTER (is_secondary) AS s, COUNT(*) FILTER ({MAPPED} = 0) AS q0, COUNT(*) FILTER ({MAPPED} >= 5) AS q5, COUNT(*) FILTER ({MAPPED} >= 20) AS q20, COUNT(*) FILTER ({MAPPED} >= 40) AS q40,
      AVG({MAPPED}) AS mean_mapq, median(CAST({MAPPED} AS DOUBLE)) AS median_mapq, SUM(CASE WHEN NOT is_secondary THEN matches / CAST(block AS DOUBLE) END) AS i, SUM(CASE WHEN NOT is_secondary THEN qend - qstart END) AS a, SUM(CASE WHEN NOT is_secondary THEN qstart + qlen - qend END) AS c FROM gaf GROUP BY 1, 2)
    SELECT sample_id, target, p AS primary_mapped_reads, ROUND(p / CAST(input_reads AS DOUBLE), 6) AS mapped_read_fraction, ROUND(q0 / CAST(input_reads AS DOUBLE), 6) AS mapq_0_fraction, ROUND(q5 / CAST(input_reads AS DOUBLE), 6) AS mapq_ge_5_fraction, ROUND(q20 / CAST(input_reads AS DOUBLE), 6) AS mapq_ge_20_fraction, ROUND(q40 / CAST(input_reads AS DOUBLE), 6) AS mapq_ge_40_fraction,
      ROUND(mean_mapq, 6) AS mean_mapq, ROUND(median_mapq, 6) AS median_mapq, ROUND(i / p, 6) AS mean_alignment_identity, ROUND(CAST(a AS DOUBLE) / input_bases, 6) AS fraction_read_bases_aligned, ROUND(CAST(c AS DOUBLE) / p, 6) AS clipped_bases_per_read, ROUND(s / CAST(input_reads AS DOUBLE), 6) AS secondary_multimapping_fraction
    FROM g JOIN tot USING (sample_id, target) WHERE p > 0""",
    ("gaf",),
)
def _(t):
    return A.mapping_metrics_input(t.gaf, totals(t), KEYS).filter("primary_mapped_reads > 0")


@query(
    "agg_10_mapping_metrics_primary",
    f"""+ {TOTALS}, g AS (SELECT sample_id, target, COUNT(*) FILTER (NOT is_secondary) AS p, COUNT(*) FILTER (is_secondary) AS secondary, COUNT(*) FILTER (NOT is_secondary AND mapq = 0) AS q0, COUNT(*) FILTER (NOT is_secondary AND mapq >= 20) AS q20, median(CAST(CASE WHEN NOT is_secondary THEN mapq END AS DOUBLE)) AS m, AVG(CASE WHEN NOT is_secondary THEN (qend - qstart) / CAST(qlen AS DOUBLE) END) AS f FROM gaf GROUP BY 1, 2)
    SELECT sample_id, target, p AS primary_alignments, greatest(input_reads - p, 0) AS unmapped_reads, secondary, ROUND(q0 / CAST(p AS DOUBLE), 6) AS mapq0_fraction, ROUND(q20 / CAST(p AS DOUBLE), 6) AS mapq20_fraction, ROUND(m, 6) AS median_mapq, ROUND(f, 6) AS mean_query_fraction FROM g JOIN tot USING (sample_id, target) WHERE p > 0""",
    ("gaf",),
)
def _(t):
    return A.mapping_metrics_primary(t.gaf, totals(t), KEYS).filter("primary_alignments > 0")


@query("agg_14_histogram_median", "SELECT sample_id, ROUND(median(CAST(mapq AS DOUBLE)), 6) AS median_mapq FROM gaf GROUP BY 1", ("gaf",))
def _(t):
    h = t.gaf.groupBy("sample_id", "mapq").agg(F.count(F.lit(1)).alias("n"))
    return h.groupBy("sample_id").agg(A.histogram_median("mapq", F.col("n")).alias("median_mapq"))


def targets(t: Tables) -> DataFrame:
    """One allele a target graph: its junctions, reference and insertion edges over the adapter's nodes 1 to 22."""
    rows = []
    for g in range(4):
        for n in range(1, 21):
            feature = ("left", "right", "reference", "insertion")[(n + g) % 4]
            rows.append((f"g{g}", "A1", feature, f">s{n}>s{n + 1}"))
    return t.spark.createDataFrame(rows, "target string, allele string, feature string, edge string")


TARGETS = "ta AS (SELECT 'g' || g AS target, 'A1' AS allele, CASE (n + g) % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' WHEN 2 THEN 'reference' ELSE 'insertion' END AS feature, '>s' || n || '>s' || (n + 1) AS edge, '<s' || (n + 1) || '<s' || n AS back FROM range(0, 4) a(g), range(1, 21) b(n))"
HITS = f"""{TOKENS}, {TARGETS}, ed AS (SELECT sample_id, target, string_split(read_name, '/')[1] AS fragment, unnest([k[1] || k[2], k[2] || k[3]]) AS e FROM tk WHERE mapq BETWEEN 5 AND 254 AND NOT is_secondary),
    hi AS (SELECT DISTINCT sample_id, ed.target, fragment, allele, feature FROM ed JOIN ta ON ta.target = ed.target AND (ed.e = ta.edge OR ed.e = ta.back))"""


def hits(t: Tables) -> DataFrame:
    return evidence.edge_hits(t.gaf, targets(t))


@query("jn_18_edge_hits", f"+ {HITS} SELECT * FROM hi", ("gaf",))
def _(t):
    return hits(t)


SUPPORT = (
    HITS
    + """, pf AS (SELECT sample_id, target, allele, fragment, bool_or(feature = 'left') AS l, bool_or(feature = 'right') AS r, bool_or(feature = 'reference') AS f, bool_or(feature = 'insertion') AS i FROM hi GROUP BY 1, 2, 3, 4),
    su AS (SELECT sample_id, target, allele, COUNT(*) FILTER (l AND NOT f) AS left_fragments, COUNT(*) FILTER (r AND NOT f) AS right_fragments, COUNT(*) FILTER (f AND NOT (l OR r)) AS reference_fragments, COUNT(*) FILTER (i) AS insertion_fragments, COUNT(*) FILTER ((l OR r) AND f) AS conflicting_fragments, COUNT(*) AS locus_fragments FROM pf GROUP BY 1, 2, 3)"""
)


def support(t: Tables) -> DataFrame:
    return evidence.fragment_support(hits(t), [*KEYS, "allele"])


@query("agg_30_fragment_support", f"+ {SUPPORT} SELECT * FROM su", ("gaf",))
def _(t):
    return support(t)


CALLS = (
    SUPPORT
    + """, ca AS (SELECT *, CASE WHEN conflicting_fragments >= 3 THEN 'CONFLICTING' WHEN least(left_fragments, right_fragments) >= 3 AND reference_fragments >= 3 THEN 'HET_LIKE' WHEN least(left_fragments, right_fragments) >= 3 THEN 'ALT_SUPPORTED'
      WHEN reference_fragments >= 3 AND left_fragments < 3 AND right_fragments < 3 THEN 'REF_SUPPORTED' WHEN greatest(left_fragments, right_fragments) >= 3 THEN 'CONFLICTING' ELSE 'NO_DECISION' END AS call FROM su)"""
)


def calls(t: Tables) -> DataFrame:
    return evidence.classify_allele_evidence(support(t))


@query("flt_16_allele_evidence", f"+ {CALLS} SELECT sample_id, target, allele, call FROM ca", ("gaf",))
def _(t):
    return calls(t).select(*KEYS, "allele", "call")


@query("agg_46_target_agreement", f"+ {CALLS} SELECT sample_id, COUNT(*) AS targets, COUNT(DISTINCT call) AS calls, CASE WHEN COUNT(*) = 1 THEN 'SINGLE' WHEN COUNT(DISTINCT call) = 1 THEN 'AGREE' ELSE 'DISAGREE' END AS agreement FROM ca GROUP BY 1", ("gaf",))
def _(t):
    return evidence.target_agreement(calls(t))


@query(
    "agg_52_call_agreement",
    f"+ {CALLS.replace('>= 3', '>= 1').replace('< 3', '< 1')}, k AS (SELECT sample_id, target, CASE WHEN call IN ('ALT_SUPPORTED', 'HET_LIKE') THEN 'ALT' WHEN call = 'REF_SUPPORTED' THEN 'REF' END AS k FROM ca) SELECT a.k AS left_call, b.k AS right_call, COUNT(*) AS samples FROM k a JOIN k b ON a.sample_id = b.sample_id AND a.target = 'g0' AND b.target = 'g2' WHERE a.k IS NOT NULL AND b.k IS NOT NULL GROUP BY 1, 2",
    ("gaf",),
)
def _(t):
    return evidence.call_agreement(evidence.classify_allele_evidence(support(t), 1, 1), "g0", "g2")


STATE = "CASE call WHEN 'HET_LIKE' THEN 'ALT_SUPPORTED' WHEN 'ALT_SUPPORTED' THEN 'ALT_SUPPORTED' WHEN 'REF_SUPPORTED' THEN 'REF_SUPPORTED' ELSE 'NO_CALL' END"


@query(
    "agg_33_carrier_summary",
    f"+ {CALLS}, s AS (SELECT target, {STATE} AS c FROM ca), g AS (SELECT target, COUNT(*) AS attempted, COUNT(*) FILTER (c <> 'NO_CALL') AS callable, COUNT(*) FILTER (c = 'ALT_SUPPORTED') AS carriers, COUNT(*) FILTER (c = 'NO_CALL') AS no_call FROM s GROUP BY 1) SELECT *, ROUND(CASE WHEN callable > 0 THEN carriers / CAST(callable AS DOUBLE) END, 6) AS carrier_frequency FROM g",
    ("gaf",),
)
def _(t):
    return evidence.carrier_summary(calls(t).withColumn("carrier_state", F.expr(STATE)), ["target"])


@query("agg_34_carrier_matrix", f"+ {CALLS}, s AS (SELECT target AS allele_id, sample_id, {STATE} AS c FROM ca), v AS (SELECT *, CASE c WHEN 'ALT_SUPPORTED' THEN '1' WHEN 'REF_SUPPORTED' THEN '0' ELSE '.' END AS v FROM s) SELECT allele_id, {', '.join(f'''COALESCE(MAX(CASE WHEN sample_id = 'S{i}' THEN v END), '.') AS S{i}''' for i in range(20))} FROM v GROUP BY 1", ("gaf",))
def _(t):
    rows = calls(t).select(F.col("target").alias("allele_id"), F.col("sample_id").alias("person_id"), F.expr(STATE).alias("carrier_state"))
    return evidence.carrier_matrix(rows, [f"S{i}" for i in range(20)])


@query(
    "agg_50_path_support",
    f"""+ {TOKENS}, n AS (SELECT sample_id, target, [CASE WHEN substr(k[1], 2) < substr(k[2], 2) THEN substr(k[1], 2) || '|' || substr(k[2], 2) ELSE substr(k[2], 2) || '|' || substr(k[1], 2) END, CASE WHEN substr(k[2], 2) < substr(k[3], 2) THEN substr(k[2], 2) || '|' || substr(k[3], 2) ELSE substr(k[3], 2) || '|' || substr(k[2], 2) END] AS ps FROM tk WHERE mapq BETWEEN 5 AND 254 AND NOT is_secondary)
    SELECT sample_id, target, COUNT(*) FILTER (list_contains(ps, 's4|s5')) AS "left", COUNT(*) FILTER (list_contains(ps, 's5|s6')) AS "right", COUNT(*) FILTER (list_contains(ps, 's4|s6')) AS reference FROM n GROUP BY 1, 2""",
    ("gaf",),
)
def _(t):
    wanted = t.spark.createDataFrame([(f"g{i}", "s4|s5", "s5|s6", "s4|s6") for i in range(4)], "target string, left_pair string, right_pair string, reference_pair string")
    return evidence.path_support(t.gaf, wanted)


@query(
    "win_11_mate_pairs",
    """+ a AS (SELECT 'L' || (event_id % 8) AS lane, event_id // 2 AS idx, string_split(read_name, '/')[1] AS n FROM gaf WHERE event_id % 2 = 0), b AS (SELECT 'L' || ((event_id - 1) % 8) AS lane, event_id // 2 AS idx, CASE WHEN event_id % 101 = 0 THEN 'x' ELSE string_split(read_name, '/')[1] END AS n FROM gaf WHERE event_id % 2 = 1 AND event_id % 77 <> 0)
    SELECT COALESCE(a.lane, b.lane) AS lane, CASE WHEN a.n IS NULL OR b.n IS NULL THEN 'UNPAIRED' WHEN a.n = b.n THEN 'PAIRED' ELSE 'NAME_MISMATCH' END AS pair_status, COUNT(*) AS pairs FROM a FULL JOIN b ON a.lane = b.lane AND a.idx = b.idx GROUP BY 1, 2""",
    ("gaf",),
)
def _(t):
    name = C.fragment_name(F.col("read_name"))
    side = lambda odd: F.concat(F.lit("L"), ((F.col("event_id") - odd) % 8).cast("string"))
    a = t.gaf.filter("event_id % 2 = 0").select(side(0).alias("lane"), F.expr("event_id div 2").alias("idx"), name.alias("name"))
    b = t.gaf.filter("event_id % 2 = 1 and event_id % 77 <> 0").select(side(1).alias("lane"), F.expr("event_id div 2").alias("idx"), F.when(F.col("event_id") % 101 == 0, "x").otherwise(name).alias("name"))
    return cohort.pair_reads(a, b).groupBy("lane", "pair_status").agg(F.count(F.lit(1)).alias("pairs"))


@query("agg_45_fastq_totals", "SELECT sample_id, COUNT(*) AS reads, CAST(SUM(qlen) AS BIGINT) AS bases, COUNT(DISTINCT event_id % 8) AS lanes FROM gaf GROUP BY 1", ("gaf",))
def _(t):
    return cohort.fastq_totals(t.gaf.select("sample_id", F.col("qlen").alias("length"), (F.col("event_id") % 8).alias("lane")), ["sample_id"])


@query("str_1_mapping_histogram", "SELECT sample_id, target, mapq, is_secondary, COUNT(*) AS rows, CAST(SUM(matches) AS BIGINT) AS matches, CAST(SUM(block) AS BIGINT) AS block FROM gaf GROUP BY 1, 2, 3, 4", ("gaf",))
def _(t):
    return streaming.mapping_histogram(t.gaf)


@query("str_1_mapping_figures", "SELECT sample_id, target, COUNT(*) AS \"primary\", ROUND(median(CAST(mapq AS DOUBLE)), 6) AS median_mapq, ROUND(COUNT(*) FILTER (mapq >= 20) / CAST(COUNT(*) AS DOUBLE), 6) AS mapq20_fraction FROM gaf WHERE NOT is_secondary GROUP BY 1, 2", ("gaf",))
def _(t):
    return streaming.mapping_figures(streaming.mapping_histogram(t.gaf))


@query("str_2_fragment_support", f"+ {HITS} SELECT sample_id, target, allele, feature, COUNT(*) AS fragments FROM hi GROUP BY 1, 2, 3, 4", ("gaf",))
def _(t):
    return streaming.stream_fragment_support(t.gaf, targets(t))


# paired metrics

METRICS = "me AS (SELECT sample_id, target, CAST(COUNT(*) AS DOUBLE) AS reads, COUNT(*) FILTER (mapq >= 20) / CAST(COUNT(*) AS DOUBLE) AS q20, CAST(SUM(matches) AS DOUBLE) / CAST(SUM(block) AS DOUBLE) AS identity FROM gaf WHERE NOT (sample_id = 'S3' AND target = 'g1') GROUP BY 1, 2)"
CONTRASTS = f"""{METRICS}, un AS (SELECT sample_id, target, unnest(['reads', 'q20', 'identity']) AS metric, unnest([reads, q20, identity]) AS value FROM me), pa AS (SELECT 'g0' AS l, 'g1' AS r UNION ALL SELECT 'g2', 'g3'), gr AS (SELECT * FROM (SELECT DISTINCT sample_id FROM me), pa, (SELECT unnest(['reads', 'q20', 'identity']) AS metric)),
    co AS (SELECT gr.sample_id, gr.l AS left_target, gr.r AS right_target, gr.metric, b.value - a.value AS difference, CASE WHEN a.value IS NULL OR b.value IS NULL THEN 'BLOCKED' ELSE 'READY' END AS status FROM gr LEFT JOIN un a ON a.sample_id = gr.sample_id AND a.target = gr.l AND a.metric = gr.metric LEFT JOIN un b ON b.sample_id = gr.sample_id AND b.target = gr.r AND b.metric = gr.metric)"""


def metrics(t: Tables) -> DataFrame:
    g = t.gaf.filter("not (sample_id = 'S3' and target = 'g1')").groupBy(*KEYS)
    return g.agg(F.count(F.lit(1)).cast("double").alias("reads"), (F.count_if(F.col("mapq") >= 20) / F.count(F.lit(1))).alias("q20"), (F.sum("matches") / F.sum("block")).alias("identity"))


def contrasts(t: Tables) -> DataFrame:
    return compare.paired_contrasts(metrics(t), [("g0", "g1"), ("g2", "g3")], ["reads", "q20", "identity"])


@query("jn_22_paired_contrasts", f"+ {CONTRASTS} SELECT sample_id, left_target, right_target, metric, ROUND(difference, 6) AS difference, status FROM co", ("gaf",))
def _(t):
    return contrasts(t)


@query("jn_23_incomplete_cells", f"+ {METRICS} SELECT s.sample_id, g.target, COUNT(me.target) AS n FROM (SELECT DISTINCT sample_id FROM me) s CROSS JOIN (SELECT DISTINCT target FROM me) g LEFT JOIN me ON me.sample_id = s.sample_id AND me.target = g.target GROUP BY 1, 2 HAVING COUNT(me.target) <> 1", ("gaf",))
def _(t):
    m = metrics(t)
    return checks.complete_cells(m, m.select("sample_id").distinct(), m.select("target").distinct(), KEYS)


STRATA = """st AS (SELECT co.*, 'B' || (CAST(substr(sample_id, 2) AS BIGINT) % 3) AS batch, CASE WHEN CAST(substr(sample_id, 2) AS BIGINT) < 10 THEN 'case' ELSE 'control' END AS arm FROM co)"""


@query(
    "agg_37_stratified_summary",
    f"""+ {CONTRASTS}, {STRATA}, x AS (SELECT metric, left_target, difference AS v, 'overall' AS stratum, 'all' AS level FROM st UNION ALL SELECT metric, left_target, difference, 'batch', batch FROM st UNION ALL SELECT metric, left_target, difference, 'arm', arm FROM st)
    SELECT metric, left_target, stratum, level, COUNT(v) AS n, ROUND(AVG(v), 6) AS mean, ROUND(median(v), 6) AS median, ROUND(MIN(v), 6) AS minimum, ROUND(MAX(v), 6) AS maximum, COUNT(*) FILTER (v > 0) AS positive, COUNT(*) FILTER (v < 0) AS negative, COUNT(*) FILTER (v = 0) AS tied FROM x GROUP BY 1, 2, 3, 4""",
    ("gaf",),
)
def _(t):
    n = F.substring("sample_id", 2, 9).cast("long")
    rows = contrasts(t).withColumns({"batch": F.concat(F.lit("B"), (n % 3).cast("string")), "arm": F.when(n < 10, "case").otherwise("control")})
    return compare.stratified_summary(rows, ["metric", "left_target"], ["batch", "arm"])


@query("st_1_sign_flip")
def _(t):
    return compare.sign_flip_tests(contrasts(t), ["metric", "left_target"])


@query(
    "st_1_exact_sign_flip",
    f"""+ {CONTRASTS}, g AS (SELECT metric, left_target, CAST(substr(sample_id, 2) AS BIGINT) % 2 AS half, COALESCE(list(difference) FILTER (difference <> 0), []) AS d, COUNT(difference) AS pairs FROM co GROUP BY 1, 2, 3),
    s AS (SELECT *, abs(list_sum(list_transform(d, lambda x, i: CASE WHEN (m >> (i - 1)) & 1 = 1 THEN -x ELSE x END))) AS flipped, abs(list_sum(d)) AS seen FROM (SELECT *, unnest(range(CAST(1 << len(d) AS BIGINT))) AS m FROM g))
    SELECT metric, left_target, half, pairs, CASE WHEN pairs > 0 THEN ROUND(AVG(CASE WHEN COALESCE(flipped, 0) >= COALESCE(seen, 0) - 1e-12 THEN 1.0 ELSE 0.0 END), 6) END AS p_value, true AS exact FROM s GROUP BY 1, 2, 3, 4""",
    ("gaf",),
)
def _(t):
    halves = contrasts(t).withColumn("half", F.substring("sample_id", 2, 9).cast("long") % 2)
    return compare.sign_flip_tests(halves, ["metric", "left_target", "half"])


@query(
    "win_7_depth_bins",
    "+ s AS (SELECT sample_id, COUNT(*) AS depth FROM gaf GROUP BY 1), r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY depth, sample_id) - 1 AS k, COUNT(*) OVER () AS n FROM s) SELECT sample_id, depth, CASE WHEN 3 * k < n THEN 'low' WHEN 3 * k < 2 * n THEN 'medium' ELSE 'high' END AS depth_bin FROM r",
    ("gaf",),
)
def _(t):
    return cohort.depth_bins(t.gaf.groupBy("sample_id").agg(F.count(F.lit(1)).alias("depth")))


P = "pv AS (SELECT target, sample_id, ((CAST(SUM(matches) AS BIGINT) * 7919) % 1000) / 1000.0 AS p FROM gaf GROUP BY 1, 2)"


def p_values(t: Tables) -> DataFrame:
    return t.gaf.groupBy("target", "sample_id").agg(((F.sum("matches") * 7919) % 1000 / 1000.0).alias("p"))


@query("st_2_benjamini_hochberg", f"+ {P}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY p, sample_id) AS k, COUNT(*) OVER (PARTITION BY target) AS n FROM pv) SELECT a.target, a.sample_id, ROUND(CAST(a.p AS DOUBLE), 6) AS p, ROUND(least(CAST(MIN(b.p * b.n / b.k) AS DOUBLE), 1.0), 6) AS q_value FROM r a JOIN r b ON a.target = b.target AND b.p >= a.p GROUP BY 1, 2, 3", ("gaf",))
def _(t):
    return stats.bh_adjust(p_values(t), "p", ["target"])


@query("st_3_holm", f"+ {P}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY p, sample_id) AS k, COUNT(*) OVER (PARTITION BY target) AS n FROM pv), m AS (SELECT target, sample_id, p, CAST(MAX(p * (n - k + 1)) OVER (PARTITION BY target ORDER BY k ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS h FROM r), z AS (SELECT target, p, MIN(h) AS h FROM m GROUP BY 1, 2) SELECT target, ROUND(CAST(p AS DOUBLE), 6) AS p, ROUND(least(MIN(h), 1.0), 6) AS holm_p FROM z GROUP BY 1, 2", ("gaf",))
def _(t):
    return stats.holm_adjust(p_values(t), "p", ["target"]).groupBy("target", "p").agg(F.min("holm_p").alias("holm_p"))


# people


@query("flt_18_eligibility", "SELECT person_id, concat_ws(';', CASE WHEN consent = 'no' THEN 'NO_CONSENT' END, CASE WHEN sequenced = 'no' THEN 'NOT_SEQUENCED' END, CASE WHEN consent = 'unknown' THEN 'CONSENT_UNKNOWN' END, CASE WHEN sequenced = 'unknown' THEN 'SEQUENCING_UNKNOWN' END) AS reasons, consent = 'yes' AND sequenced = 'yes' AS eligible FROM people", ("people",))
def _(t):
    return cohort.eligibility(t.people, {"consent": ("NO_CONSENT", "CONSENT_UNKNOWN"), "sequenced": ("NOT_SEQUENCED", "SEQUENCING_UNKNOWN")}).select("person_id", "reasons", "eligible")


@query("agg_35_sample_flow", "+ n AS (SELECT COUNT(*) AS a, COUNT(*) FILTER (consent = 'yes') AS b, COUNT(*) FILTER (consent = 'yes' AND sequenced = 'yes') AS c, COUNT(*) FILTER (consent = 'yes' AND sequenced = 'yes' AND depth >= 30) AS d FROM people) SELECT unnest([0, 1, 2, 3])::BIGINT AS step, unnest(['all', 'consent', 'sequenced', 'deep']) AS name, unnest([a, b, c, d]) AS samples, unnest([a, a, b, c]) AS denominator FROM n", ("people",))
def _(t):
    return cohort.sample_flow(t.people, [("consent", F.col("consent") == "yes"), ("sequenced", F.col("sequenced") == "yes"), ("deep", F.col("depth") >= 30)])


@query(
    "agg_38_missingness",
    """+ r AS (SELECT *, consent = 'unknown' AS m, CAST(ceil(4.0 * RANK() OVER (ORDER BY depth) / COUNT(*) OVER ()) AS BIGINT) AS q FROM people), x AS (SELECT m, 'phenotype' AS stratum, phenotype AS level FROM r UNION ALL SELECT m, 'batch', batch FROM r UNION ALL SELECT m, 'depth_quartile', CAST(q AS STRING) FROM r)
    SELECT stratum, level, COUNT(*) AS cells, COUNT(*) FILTER (m) AS missing, ROUND(COUNT(*) FILTER (m) / CAST(COUNT(*) AS DOUBLE), 6) AS missing_fraction FROM x GROUP BY 1, 2""",
    ("people",),
)
def _(t):
    return cohort.missingness(t.people.withColumn("v", F.when(F.col("consent") != "unknown", F.col("consent"))), "v", ["phenotype", "batch"], "depth")


@query("agg_39_inclusion", "+ k AS (SELECT phenotype, person % 3 AS k FROM people) SELECT phenotype, COUNT(*) AS samples, COUNT(*) FILTER (k = 2) AS \"full\", COUNT(*) FILTER (k = 1) AS partial, COUNT(*) FILTER (k = 0) AS excluded, CAST(SUM(k) AS BIGINT) AS haplotypes, ROUND(COUNT(*) FILTER (k = 2) / CAST(COUNT(*) AS DOUBLE), 6) AS full_rate, ROUND(CAST(SUM(k) AS DOUBLE) / (2 * COUNT(*)), 6) AS haplotype_rate FROM k GROUP BY 1", ("people",))
def _(t):
    return cohort.inclusion_stats(t.people.withColumn("kept_haplotypes", F.col("person") % 3), "phenotype")


ALIASES = "al AS (SELECT 'lab' AS ns, 'x' || (person % 500) AS a, person_id FROM people)"


@query("jn_14_identity", f"+ {ALIASES}, o AS (SELECT ns, a, COUNT(DISTINCT person_id) AS n, MIN(person_id) AS p FROM al GROUP BY 1, 2), r AS (SELECT person, 'x' || (person % 700) AS a FROM people) SELECT person, CASE WHEN n = 1 THEN p END AS person_id, CASE WHEN n IS NULL THEN 'UNRESOLVED' WHEN n > 1 THEN 'CONFLICT' ELSE 'RESOLVED' END AS identity_status FROM r LEFT JOIN o USING (a)", ("people",))
def _(t):
    aliases = t.people.select(F.lit("lab").alias("namespace"), F.concat(F.lit("x"), (F.col("person") % 500).cast("string")).alias("alias"), "person_id")
    reads = t.people.select("person", F.lit("lab").alias("namespace"), F.concat(F.lit("x"), (F.col("person") % 700).cast("string")).alias("alias"))
    return cohort.resolve_identity(reads, aliases).select("person", "person_id", "identity_status")


@query("jn_14_identity_whole", f"+ {ALIASES}, o AS (SELECT ns, a, COUNT(DISTINCT person_id) AS n, MIN(person_id) AS p FROM al GROUP BY 1, 2), r AS (SELECT person, 'x' || (person % 700) AS a FROM people) SELECT person, CASE WHEN n = 1 THEN p END AS person_id, CASE WHEN n IS NULL THEN 'UNRESOLVED' WHEN n > 1 THEN 'CONFLICT' ELSE 'RESOLVED' END AS identity_status FROM r LEFT JOIN o USING (a)", ("people",))
def _(t):
    aliases = t.people.select(F.lit("lab").alias("namespace"), F.concat(F.lit("x"), (F.col("person") % 500).cast("string")).alias("alias"), "person_id")
    reads = t.people.select("person", F.lit("lab").alias("namespace"), F.concat(F.lit("x"), (F.col("person") % 700).cast("string")).alias("alias"))
    return cohort.resolve_identity(reads, aliases).select("person", "person_id", "identity_status")


@query(
    "jn_15_phenotypes",
    """+ s AS (SELECT person AS source_id, CASE WHEN person % 4 <> 0 THEN phenotype END AS ph, CASE WHEN person % 9 <> 0 THEN person_id END AS pid FROM people), k AS (SELECT person_id, CASE WHEN person % 3 = 0 THEN phenotype WHEN person % 50 = 1 THEN 'OTHER' END AS known FROM people)
    SELECT source_id, pid AS person_id, COALESCE(known, ph) AS phenotype, CASE WHEN pid IS NULL THEN 'UNMAPPED' WHEN ph IS NOT NULL AND known IS NOT NULL AND ph <> known THEN 'CONFLICT' ELSE 'MAPPED' END AS mapping_status FROM s LEFT JOIN k ON k.person_id = s.pid""",
    ("people",),
)
def _(t):
    n = F.col("person")
    source = t.people.select(n.alias("source_id"), F.when(n % 4 != 0, F.col("phenotype")).alias("phenotype"))
    crosswalk = t.people.filter("person % 9 <> 0").select(n.alias("source_id"), "person_id")
    samples = t.people.select("person_id", F.when(n % 3 == 0, F.col("phenotype")).when(n % 50 == 1, "OTHER").alias("phenotype"))
    return cohort.join_phenotypes(source, crosswalk, samples).select("source_id", "person_id", "phenotype", "mapping_status")


@query(
    "jn_16_membership_audit",
    """+ g AS (SELECT 'g' || i AS graph, i < 2 AS headline FROM range(0, 4) r(i)), m AS (SELECT person_id AS sample_id, 'g' || (person % 3) AS graph FROM people WHERE person % 4 = 0), x AS (SELECT p.person_id AS sample_id, g.graph, headline, person % 5 = 0 AS held_out, m.graph IS NOT NULL AS member, g.graph <> 'g3' AS known FROM people p CROSS JOIN g LEFT JOIN m ON m.sample_id = p.person_id AND m.graph = g.graph)
    SELECT sample_id, graph, CASE WHEN member THEN 'MEMBER' WHEN known THEN 'ABSENT' ELSE 'UNKNOWN' END AS membership, CASE WHEN held_out AND headline AND member THEN 'FAIL' WHEN NOT member AND NOT known THEN 'UNKNOWN' ELSE 'PASS' END AS audit FROM x""",
    ("people",),
)
def _(t):
    graphs = t.spark.createDataFrame([(f"g{i}", i < 2) for i in range(4)], "graph string, headline boolean")
    samples = t.people.select(F.col("person_id").alias("sample_id"), (F.col("person") % 5 == 0).alias("held_out"))
    members = t.people.filter("person % 4 = 0").select(F.col("person_id").alias("sample_id"), F.concat(F.lit("g"), (F.col("person") % 3).cast("string")).alias("graph"))
    return cohort.membership_audit(samples, graphs, members).select("sample_id", "graph", "membership", "audit")


@query(
    "jn_20_representation",
    """+ r AS (SELECT 'r' || i AS resource, i < 2 AS reviewed FROM range(0, 3) q(i)), h AS (SELECT person_id AS allele_id, 'r' || (person % 5) AS resource FROM people WHERE person % 2 = 0), x AS (SELECT p.person_id AS allele_id, r.resource, reviewed, (SELECT COUNT(*) FROM h WHERE h.allele_id = p.person_id AND h.resource = r.resource) AS hits FROM people p CROSS JOIN r),
    y AS (SELECT *, CASE WHEN NOT reviewed THEN 'UNDECIDED' WHEN hits > 0 THEN 'REPRESENTED' ELSE 'NOT_REPRESENTED' END AS status FROM x) SELECT allele_id, resource, hits, status, bool_and(status = 'NOT_REPRESENTED') OVER (PARTITION BY allele_id) AS absent_everywhere FROM y""",
    ("people",),
)
def _(t):
    resources = t.spark.createDataFrame([(f"r{i}", i < 2) for i in range(3)], "resource string, reviewed boolean")
    hit = t.people.filter("person % 2 = 0").select(F.col("person_id").alias("allele_id"), F.concat(F.lit("r"), (F.col("person") % 5).cast("string")).alias("resource"))
    return cohort.representation_matrix(t.people.select(F.col("person_id").alias("allele_id")), resources, hit).select("allele_id", "resource", "hits", "status", "absent_everywhere")


@query("agg_55_candidate_flow", "SELECT phenotype AS status, COUNT(*) AS records, COUNT(DISTINCT person % 100) AS alleles, COUNT(DISTINCT batch) AS loci FROM people GROUP BY 1", ("people",))
def _(t):
    return cohort.candidate_flow(t.people.select(F.col("phenotype").alias("status"), (F.col("person") % 100).alias("allele_id"), F.col("batch").alias("locus_id")))


@query("flt_27_manifest_conflicts", "SELECT person % 400 AS k, COUNT(DISTINCT phenotype || batch) AS versions FROM people GROUP BY 1 HAVING COUNT(DISTINCT phenotype || batch) > 1", ("people",))
def _(t):
    return checks.grouped_conflicts(t.people.withColumn("k", F.col("person") % 400), ["k"], ["phenotype", "batch"])


@query(
    "smp_2_affine_sample",
    """+ n AS (SELECT COUNT(*) AS n FROM gaf), euclid AS (SELECT CAST(n AS HUGEINT) AS r0, CAST(7919 AS HUGEINT) % n AS r1, CAST(0 AS HUGEINT) AS t0, CAST(1 AS HUGEINT) AS t1 FROM n UNION ALL SELECT r1, r0 % r1, t1, t0 - (r0 // r1) * t1 FROM euclid WHERE r1 > 0),
    i AS (SELECT (t0 % n + n) % n AS inv FROM euclid, n WHERE r1 = 0 AND r0 = 1) SELECT event_id, CAST((((CAST(event_id AS HUGEINT) - 12345) * inv) % n + n) % n AS BIGINT) AS sample_place FROM gaf, n, i WHERE (((CAST(event_id AS HUGEINT) - 12345) * inv) % n + n) % n < 500""",
    ("gaf",),
)
def _(t):
    total = t.gaf.count()
    return cohort.affine_sample(t.gaf, "event_id", total, 500, 7919, 12345).select("event_id", "sample_place")


@query(
    "smp_3_quota_sample",
    """+ s AS (SELECT batch, COUNT(*) AS n FROM people GROUP BY 1), f AS (SELECT batch, 100.0 * n / SUM(n) OVER () AS sh FROM s), b AS (SELECT batch, CAST(floor(sh) AS BIGINT) AS ba, ROUND(sh - floor(sh), 9) AS fr FROM f), q AS (SELECT batch, ba + CASE WHEN ROW_NUMBER() OVER (ORDER BY fr DESC, batch) <= 100 - SUM(ba) OVER () THEN 1 ELSE 0 END AS quota FROM b),
    r AS (SELECT person_id, batch, ROW_NUMBER() OVER (PARTITION BY batch ORDER BY abs(depth - 30), sha256('s1' || chr(0) || person_id)) AS k FROM people) SELECT person_id, batch FROM r JOIN q USING (batch) WHERE k <= quota""",
    ("people",),
)
def _(t):
    return cohort.quota_sample(t.people, 100, "s1", key="person_id").select("person_id", "batch")


@query("smp_1_hash_sample")
def _(t):
    return cohort.hash_sample(t.gaf, "read_name", "7", 0.1).select("read_name")


@query(
    "smp_1_coverage_report",
    """+ r AS (SELECT DISTINCT sample_id, read_name, qlen FROM gaf), s AS (SELECT sample_id, COUNT(*) AS total_reads, CAST(SUM(qlen) AS BIGINT) AS total_bases FROM r GROUP BY 1)
    SELECT sample_id, total_reads, total_bases, 3000 AS requested_bases, ROUND(least(1.0, 3000 / CAST(total_bases AS DOUBLE)), 6) AS sampling_fraction FROM s""",
    ("gaf",),
)
def _(t):
    reads = t.gaf.select("sample_id", "read_name", "qlen").distinct()
    return cohort.coverage_sample(reads, ["sample_id"], "read_name", "qlen", "7", 1.5, 2000)[1].select("sample_id", "total_reads", "total_bases", "requested_bases", "sampling_fraction")


TABLE = "tb AS (SELECT batch, COUNT(*) FILTER (carrier = 1 AND affected = 1) AS a, COUNT(*) FILTER (carrier = 1 AND affected = 0) AS b, COUNT(*) FILTER (carrier = 0 AND affected = 1) AS c, COUNT(*) FILTER (carrier = 0 AND affected = 0) AS d FROM people GROUP BY 1)"


@query(
    "st_4_two_by_two",
    f"""+ {TABLE}, z AS (SELECT *, CASE WHEN a = 0 OR b = 0 OR c = 0 OR d = 0 THEN 0.5 ELSE 0 END AS k FROM tb), o AS (SELECT *, CAST((a + k) * (d + k) AS DOUBLE) / CAST((b + k) * (c + k) AS DOUBLE) AS orr, sqrt(1 / CAST(a + k AS DOUBLE) + 1 / CAST(b + k AS DOUBLE) + 1 / CAST(c + k AS DOUBLE) + 1 / CAST(d + k AS DOUBLE)) AS se FROM z)
    SELECT batch, a, b, c, d, ROUND(CASE WHEN a + b > 0 AND c + d > 0 THEN a / CAST(a + b AS DOUBLE) - c / CAST(c + d AS DOUBLE) END, 6) AS risk_difference, ROUND(orr, 6) AS odds_ratio, ROUND(exp(ln(orr) - 1.959963984540054 * se), 6) AS or_low, ROUND(exp(ln(orr) + 1.959963984540054 * se), 6) AS or_high FROM o""",
    ("people",),
)
def _(t):
    n = lambda x, y: F.count_if((F.col("carrier") == x) & (F.col("affected") == y))
    return stats.two_by_two(t.people.groupBy("batch").agg(n(1, 1).alias("a"), n(1, 0).alias("b"), n(0, 1).alias("c"), n(0, 0).alias("d"))).drop("risk_ratio", "fisher_p")


@query("st_5_carrier_intervals", "SELECT batch, COUNT(*) AS callable, CAST(SUM(carrier) AS BIGINT) AS carriers FROM people GROUP BY 1", ("people",))
def _(t):
    return stats.carrier_counts(t.people, ["batch"]).drop("ci_low", "ci_high")


@query("st_6_firth_tests")
def _(t):
    return stats.firth_tests(t.people.withColumn("deep", (F.col("depth") > 30).cast("int")), "batch", "affected", "carrier", ["deep"])


@query(
    "st_6_saturated_firth",
    f"""+ {TABLE}, e AS (SELECT *, a + b >= 3 AND c + d >= 3 AND a + c > 0 AND b + d > 0 AND a + b + c + d > 2 AS ok, ln((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5))) AS beta FROM tb)
    SELECT batch, a + b + c + d AS n, CASE WHEN ok THEN ROUND(beta, 6) END AS beta, CASE WHEN ok THEN ROUND(exp(beta), 6) END AS odds_ratio, CASE WHEN ok THEN 'ESTIMATED' ELSE 'SKIPPED' END AS status FROM e""",
    ("people",),
)
def _(t):
    """Without covariates the model is saturated: Firth's estimate is the log odds ratio with a half added to each cell."""
    return stats.firth_tests(t.people, "batch", "affected", "carrier", []).select("batch", "n", "beta", "odds_ratio", "status")


@query(
    "st_9_binary_scores",
    """+ s AS (SELECT batch, affected AS y, CAST(1 + (depth * 7 + person) % 98 AS DOUBLE) / 100 AS p FROM people), k AS (SELECT *, AVG(r) OVER (PARTITION BY batch, p) AS rk FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY batch ORDER BY p) AS r FROM s)),
    g AS (SELECT batch, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS positives, AVG(-(y * ln(p) + (1 - y) * ln(1 - p))) AS ll, AVG((p - y) * (p - y)) AS br, SUM(CASE WHEN y = 1 THEN rk END) AS r FROM k GROUP BY 1)
    SELECT batch, n, positives, ROUND(ll, 6) AS log_loss, ROUND(br * n, 4) AS brier_sum, ROUND(CASE WHEN positives > 0 AND positives < n THEN (r - positives * (positives + 1) / 2.0) / (positives * (n - positives)) END, 6) AS auc FROM g""",
    ("people",),
)
def _(t):
    rows = t.people.select("batch", F.col("affected").alias("y"), ((1 + (F.col("depth") * 7 + F.col("person")) % 98).cast("double") / 100).alias("p"))
    return stats.binary_scores(rows, ["batch"], "y", "p").withColumn("brier_sum", F.round(F.col("brier") * F.col("n"), 4)).drop("brier")


@query("st_10_group_bootstrap")
def _(t):
    return stats.group_bootstrap(t.people.withColumn("loss", F.col("depth").cast("double")), ["phenotype"], "batch", "loss")


# sequences


@query("scl_14_reverse_complement", "SELECT contig, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM sequences", ("sequences",))
def _(t):
    return t.sequences.select("contig", C.reverse_complement(F.col("seq")).alias("rc"))


@query("scl_16_mask_bases", "+ s AS (SELECT contig, upper(translate(seq, 'Nß', 'RS')) AS q FROM sequences) SELECT contig, translate(q, 'RYSWKMBDHV', 'NNNNNNNNNN') AS seq, CAST(length(q) - length(translate(q, 'RYSWKMBDHV', '')) AS BIGINT) AS masked, CAST(0 AS BIGINT) AS \"lower\", regexp_full_match(translate(q, 'RYSWKMBDHV', 'NNNNNNNNNN'), '[ACGTN]*') AS ok FROM s", ("sequences",))
def _(t):
    q = F.translate("seq", "Nß", "RS")
    return t.sequences.select("contig", C.mask_bases(q).alias("m")).select("contig", "m.seq", "m.masked", F.lit(0).cast("long").alias("lower"), "m.ok")


@query("scl_16_mask_bases_whole", "+ s AS (SELECT contig, upper(translate(seq, 'Nß', 'RS')) AS q FROM sequences) SELECT contig, translate(q, 'RYSWKMBDHV', 'NNNNNNNNNN') AS seq, CAST(length(q) - length(translate(q, 'RYSWKMBDHV', '')) AS BIGINT) AS masked, CAST(0 AS BIGINT) AS \"lower\", regexp_full_match(translate(q, 'RYSWKMBDHV', 'NNNNNNNNNN'), '[ACGTN]*') AS ok FROM s", ("sequences",))
def _(t):
    q = F.translate("seq", "Nß", "RS")
    return t.sequences.select("contig", C.mask_bases(q).alias("m")).select("contig", "m.seq", "m.masked", F.lit(0).cast("long").alias("lower"), "m.ok")


@query("scl_15_windows", "+ w AS (SELECT contig, 'w' || contig AS window_id, contig % 50 AS s, contig % 50 + 300 AS e, seq FROM sequences) SELECT window_id, substr(seq, s + 1, 300) AS window_seq, length(substr(seq, s + 1, 300)) < 300 AS truncated FROM w", ("sequences",))
def _(t):
    windows = t.sequences.select(F.concat(F.lit("w"), F.col("contig").cast("string")).alias("window_id"), "contig", (F.col("contig") % 50).alias("start"), (F.col("contig") % 50 + 300).alias("end_"))
    return annotate.extract_windows(t.sequences, windows, 128).select("window_id", "window_seq", "truncated")


@query("win_10_duplicate_sequences", "+ h AS (SELECT contig, sha256(upper(seq)) AS x FROM sequences) SELECT contig, MIN(contig) OVER (PARTITION BY x) AS first_name, CASE WHEN contig = MIN(contig) OVER (PARTITION BY x) THEN 'INCLUDED' ELSE 'DUPLICATE_SEQUENCE' END AS status FROM h", ("sequences",))
def _(t):
    return cohort.dedupe_sequences(t.sequences, "contig", "seq", "contig").select("contig", "first_name", "status")


def panel(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([("ACGTA", "p1"), ("TACGN", "p1"), ("NACGT", "p2"), ("GTACA", "p2")], "kmer string, panel_group string")


COUNT = "(SELECT COUNT(*) FROM range(1, length(seq) - 3) r(i) WHERE substr(seq, i, 5) IN ({}))"


@query("agg_41_panel_kmers", f"+ c AS (SELECT contig, 'p1' AS panel_group, {COUNT.format(chr(39) + 'ACGTA' + chr(39) + ', ' + chr(39) + 'TACGN' + chr(39))} AS hits FROM sequences UNION ALL SELECT contig, 'p2', {COUNT.format(chr(39) + 'NACGT' + chr(39) + ', ' + chr(39) + 'GTACA' + chr(39))} FROM sequences) SELECT * FROM c WHERE hits > 0", ("sequences",))
def _(t):
    return evidence.count_kmers(t.sequences, panel(t), 5, ["contig"])


@query("scl_32_distinct_kmers", "+ k AS (SELECT contig, unnest(list_transform(range(1, length(q) - 5), lambda i: substr(q, i, 7))) AS k FROM (SELECT contig, seq AS q FROM sequences) WHERE length(q) >= 7) SELECT contig AS name, COUNT(DISTINCT k) AS kmers FROM k WHERE regexp_full_match(k, '[ACGT]+') GROUP BY 1", ("sequences",))
def _(t):
    return evidence.distinct_kmers(t.sequences.select(F.col("contig").alias("name"), "seq"), 7)


@query("scl_32_distinct_kmers_whole", "+ k AS (SELECT contig, unnest(list_transform(range(1, length(q) - 5), lambda i: substr(q, i, 7))) AS k FROM (SELECT contig, seq AS q FROM sequences) WHERE length(q) >= 7) SELECT contig AS name, COUNT(DISTINCT k) AS kmers FROM k WHERE regexp_full_match(k, '[ACGT]+') GROUP BY 1", ("sequences",))
def _(t):
    return evidence.distinct_kmers(t.sequences.select(F.col("contig").alias("name"), "seq"), 7)


@query(
    "flt_5_apply_decisions",
    """+ c AS (SELECT contig, CAST(length(seq) AS BIGINT) AS n, CASE contig % 4 WHEN 0 THEN 'KEEP' WHEN 1 THEN 'REMOVE' WHEN 2 THEN 'SPLIT' ELSE 'REVIEW' END AS d FROM sequences WHERE length(seq) > 60)
    SELECT contig, CAST(0 AS BIGINT) AS start, n AS end_, CASE d WHEN 'KEEP' THEN 'KEPT' WHEN 'REMOVE' THEN 'REMOVED' ELSE 'REVIEW' END AS action FROM c WHERE d <> 'SPLIT' UNION ALL SELECT contig, 0, 10, 'KEPT' FROM c WHERE d = 'SPLIT' UNION ALL SELECT contig, 10, 40, 'REMOVED' FROM c WHERE d = 'SPLIT' UNION ALL SELECT contig, 40, n, 'KEPT' FROM c WHERE d = 'SPLIT'""",
    ("sequences",),
)
def _(t):
    from ..operators.qc import apply_decisions

    n = F.col("contig") % 4
    contigs = t.sequences.filter("length(seq) > 60").select("contig", F.length("seq").cast("long").alias("length"))
    decisions = contigs.select("contig", F.when(n == 0, "KEEP").when(n == 1, "REMOVE").when(n == 2, "SPLIT").otherwise("REVIEW").alias("decision"))
    cut = contigs.select("contig", F.explode(F.array(F.struct(F.lit(10).cast("long").alias("start"), F.lit(30).cast("long").alias("end_")), F.struct(F.lit(30).cast("long").alias("start"), F.lit(40).cast("long").alias("end_")))).alias("i")).select("contig", "i.*")
    return apply_decisions(contigs, decisions, cut).select("contig", "start", "end_", "action")
