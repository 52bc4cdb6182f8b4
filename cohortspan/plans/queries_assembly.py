"""Queries on alignments, intervals, assembly quality and contamination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import alignments as A
from ..operators import checks, intervals, qc
from .registry import Tables, query

FAIL = {
    "min_total_length_bp": 2_600_000_000, "max_total_length_bp": 3_350_000_000, "min_contig_n50_bp": 2_000_000, "max_n_percent": 2.5, "min_compleasm_complete_percent": 82, "max_compleasm_duplicated_percent": 10,
    "min_best_query_aligned_percent": 86, "min_best_reference_covered_percent": 86, "min_best_alignment_identity_percent": 97,
}
WARN = {
    "min_total_length_bp": 2_700_000_000, "max_total_length_bp": 3_250_000_000, "min_contig_n50_bp": 10_000_000, "max_n_percent": 1.5, "min_compleasm_complete_percent": 88, "max_compleasm_duplicated_percent": 6,
    "min_best_query_aligned_percent": 90, "min_best_reference_covered_percent": 90, "min_best_alignment_identity_percent": 98,
}
INTERVAL_LIMITS = {
    "remove_min_nonhuman_bp": 50_000, "remove_min_nonhuman_percent": 8.0, "remove_max_human_percent": 15.0, "split_min_nonhuman_bp": 20_000, "split_min_nonhuman_percent": 1.0, "split_max_human_overlap_percent": 20.0,
    "split_min_human_outside_bp": 10_000, "review_min_nonhuman_bp": 5_000,
}


def sweep(source: str, keys: str, start: str, end: str, name: str) -> str:
    """Covered bases by an event sweep: an independent form of the interval union."""
    return f"""{name} AS (SELECT {keys}, CAST(SUM(CASE WHEN depth > 0 THEN nxt - p ELSE 0 END) AS BIGINT) AS bp FROM (
      SELECT {keys}, p, SUM(d) OVER (PARTITION BY {keys} ORDER BY p) AS depth, LEAD(p) OVER (PARTITION BY {keys} ORDER BY p) AS nxt FROM (
        SELECT {keys}, p, SUM(d) AS d FROM (SELECT {keys}, {start} AS p, 1 AS d FROM {source} UNION ALL SELECT {keys}, {end}, -1 FROM {source}) GROUP BY {keys}, p)) GROUP BY {keys})"""


KEYS = ["assembly_id", "contig"]


def human(t: Tables) -> DataFrame:
    return A.filter_alignments(t.alignments, min_mapq=30).select(*KEYS, F.col("qstart").alias("start"), F.col("qend").alias("end_"))


HUMAN = "human AS (SELECT assembly_id, contig, qstart AS start, qend AS end_ FROM alignments WHERE mapq >= 30)"


@query("agg_4_interval_union_length", "+" + sweep("alignments", "assembly_id, reference, contig", "qstart", "qend", "u") + " SELECT assembly_id, reference, contig, bp AS covered_bp FROM u", ("alignments",))
def _(t):
    return intervals.union_length(t.alignments, ["assembly_id", "reference", "contig"], "qstart", "qend")


@query(
    "agg_4_merged_intervals",
    """+ m AS (SELECT assembly_id, contig, qstart, qend, CASE WHEN qstart <= MAX(qend) OVER (PARTITION BY assembly_id, contig ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100 THEN 0 ELSE 1 END AS f FROM alignments),
    i AS (SELECT *, SUM(f) OVER (PARTITION BY assembly_id, contig ORDER BY qstart, qend ROWS UNBOUNDED PRECEDING) AS g FROM m)
    SELECT assembly_id, contig, MIN(qstart) AS qstart, MAX(qend) AS qend FROM i GROUP BY assembly_id, contig, g""",
    ("alignments",),
)
def _(t):
    return intervals.merge_intervals(t.alignments, KEYS, "qstart", "qend", gap=100)


@query(
    "agg_5_intersection_length",
    f"""+ {HUMAN}, nh AS (SELECT assembly_id, contig, start, end_ FROM nonhuman),
    ev AS (SELECT assembly_id, contig, start AS p, 1 AS a, 0 AS b FROM human UNION ALL SELECT assembly_id, contig, end_, -1, 0 FROM human UNION ALL SELECT assembly_id, contig, start, 0, 1 FROM nh UNION ALL SELECT assembly_id, contig, end_, 0, -1 FROM nh),
    g AS (SELECT assembly_id, contig, p, SUM(a) AS a, SUM(b) AS b FROM ev GROUP BY 1, 2, 3),
    c AS (SELECT assembly_id, contig, p, SUM(a) OVER w AS a, SUM(b) OVER w AS b, LEAD(p) OVER w AS n FROM g WINDOW w AS (PARTITION BY assembly_id, contig ORDER BY p))
    SELECT assembly_id, contig, CAST(SUM(n - p) AS BIGINT) AS shared_bp FROM c WHERE a > 0 AND b > 0 GROUP BY 1, 2""",
    ("alignments", "nonhuman"),
)
def _(t):
    return intervals.intersection_length(human(t), t.nonhuman, KEYS)


@query(
    "agg_6_complement_intervals",
    """+ ev AS (SELECT assembly_id, contig, start AS p, 1 AS d FROM nonhuman UNION ALL SELECT assembly_id, contig, end_, -1 FROM nonhuman UNION ALL SELECT assembly_id, contig, 0, 0 FROM contigs UNION ALL SELECT assembly_id, contig, length, 0 FROM contigs),
    g AS (SELECT assembly_id, contig, p, SUM(d) AS d FROM ev GROUP BY 1, 2, 3),
    c AS (SELECT assembly_id, contig, p, SUM(d) OVER w AS depth, LEAD(p) OVER w AS n FROM g WINDOW w AS (PARTITION BY assembly_id, contig ORDER BY p))
    SELECT assembly_id, contig, p AS start, n AS end_ FROM c WHERE depth = 0 AND n IS NOT NULL AND n > p AND n <= 2010000
    """,
    ("nonhuman", "contigs"),
)
def _(t):
    return intervals.complement_intervals(t.nonhuman, t.contigs, KEYS)


@query("agg_7_nonhuman_evidence", "SELECT assembly_id, contig, string_agg(DISTINCT grp, ';' ORDER BY grp) AS groups, MAX(identity) AS best_identity, COUNT(*) AS hits, MAX(end_ - start) AS largest_hit_bp FROM nonhuman GROUP BY 1, 2", ("nonhuman",))
def _(t):
    return qc.nonhuman_evidence(t.nonhuman, KEYS)


TAXA = [(2, "bacteria"), (10239, "viruses")]


def taxonomy(t: Tables) -> DataFrame:
    targets = t.spark.createDataFrame(TAXA, "taxid long, taxon_group string")
    calls = t.taxon_calls.withColumn("taxid", F.col("taxid").cast("long"))
    return qc.classify_contigs_taxonomy(t.contigs, human(t), calls, targets, max_human=8.0)


TAXONOMY = f"""+ {HUMAN}, {sweep("human", "assembly_id, contig", "start", "end_", "u")},
    d AS (SELECT c.assembly_id, c.contig, c.length, COALESCE(u.bp, 0) AS human_bp, 100.0 * COALESCE(u.bp, 0) / c.length AS human_percent, CASE t.taxid WHEN 2 THEN 'bacteria' WHEN 10239 THEN 'viruses' END AS taxon_group
      FROM contigs c LEFT JOIN u USING (assembly_id, contig) LEFT JOIN taxon_calls t USING (assembly_id, contig)),
    decided AS (SELECT *, CASE WHEN taxon_group IS NULL THEN 'KEEP' WHEN human_percent <= 8.0 THEN 'REMOVE' ELSE 'REVIEW' END AS decision FROM d)"""


@query("flt_4_contig_taxonomy_decision", TAXONOMY + " SELECT assembly_id, contig, length, human_bp, ROUND(CAST(human_percent AS DOUBLE), 6) AS human_percent, taxon_group, decision FROM decided", ("alignments", "contigs", "taxon_calls"))
def _(t):
    return taxonomy(t)


@query(
    "agg_8_contamination_summary",
    TAXONOMY
    + """ SELECT assembly_id, COUNT(*) AS contigs, COUNT(*) FILTER (decision = 'REMOVE') AS remove_contigs, CAST(SUM(CASE WHEN decision = 'REMOVE' THEN length ELSE 0 END) AS BIGINT) AS remove_bp,
    COUNT(*) FILTER (decision = 'REVIEW') AS review_contigs, CAST(SUM(CASE WHEN decision = 'REVIEW' THEN length ELSE 0 END) AS BIGINT) AS review_bp, COUNT(*) FILTER (decision = 'SPLIT') AS split_contigs, CAST(0 AS BIGINT) AS split_bp FROM decided GROUP BY 1""",
    ("alignments", "contigs", "taxon_calls"),
)
def flagship(t):
    return qc.contamination_summary(taxonomy(t), t.contigs.select("assembly_id").distinct())


@query(
    "flt_3_contig_interval_decision",
    f"""+ {HUMAN}, nh AS (SELECT assembly_id, contig, start, end_ FROM nonhuman), {sweep("human", "assembly_id, contig", "start", "end_", "hu")}, {sweep("nh", "assembly_id, contig", "start", "end_", "nu")},
    ev AS (SELECT assembly_id, contig, start AS p, 1 AS a, 0 AS b FROM human UNION ALL SELECT assembly_id, contig, end_, -1, 0 FROM human UNION ALL SELECT assembly_id, contig, start, 0, 1 FROM nh UNION ALL SELECT assembly_id, contig, end_, 0, -1 FROM nh),
    g AS (SELECT assembly_id, contig, p, SUM(a) AS a, SUM(b) AS b FROM ev GROUP BY 1, 2, 3),
    c AS (SELECT assembly_id, contig, p, SUM(a) OVER w AS a, SUM(b) OVER w AS b, LEAD(p) OVER w AS n FROM g WINDOW w AS (PARTITION BY assembly_id, contig ORDER BY p)),
    o AS (SELECT assembly_id, contig, CAST(SUM(n - p) AS BIGINT) AS bp FROM c WHERE a > 0 AND b > 0 GROUP BY 1, 2),
    m AS (SELECT k.assembly_id, k.contig, k.length, COALESCE(nu.bp, 0) AS nonhuman_bp, COALESCE(hu.bp, 0) AS human_bp, COALESCE(o.bp, 0) AS overlap_bp FROM contigs k LEFT JOIN nu USING (assembly_id, contig) LEFT JOIN hu USING (assembly_id, contig) LEFT JOIN o USING (assembly_id, contig))
    SELECT assembly_id, contig, nonhuman_bp, human_bp, overlap_bp, CASE WHEN nonhuman_bp >= 50000 AND 100.0*nonhuman_bp/length >= 8 AND 100.0*human_bp/length <= 15 THEN 'REMOVE'
      WHEN nonhuman_bp >= 20000 AND 100.0*nonhuman_bp/length >= 1 AND 100.0*nonhuman_bp/length < 8 AND (CASE WHEN nonhuman_bp > 0 THEN 100.0*overlap_bp/nonhuman_bp ELSE 0 END) <= 20 AND human_bp - overlap_bp >= 10000 THEN 'SPLIT'
      WHEN nonhuman_bp >= 5000 THEN 'REVIEW' ELSE 'KEEP' END AS decision FROM m""",
    ("alignments", "nonhuman", "contigs"),
)
def _(t):
    return qc.classify_contigs_intervals(t.contigs, human(t), t.nonhuman, INTERVAL_LIMITS).select(*KEYS, "nonhuman_bp", "human_bp", "overlap_bp", "decision")


@query("flt_6_accepted_alignments", "SELECT assembly_id, COUNT(*) AS alignments, CAST(SUM(block) AS BIGINT) AS bp FROM alignments WHERE mapq >= 20 AND matches >= 0.95 * block AND block >= 1000 AND NOT is_secondary GROUP BY 1", ("alignments",))
def _(t):
    return A.filter_alignments(t.alignments, 20, 0.95, 1000, True).groupBy("assembly_id").agg(F.count(F.lit(1)).alias("alignments"), F.sum("block").alias("bp"))


TOTALS = "totals AS (SELECT assembly_id, CAST(SUM(length) AS BIGINT) AS total_bp FROM contigs GROUP BY 1)"


def totals(t: Tables) -> DataFrame:
    return t.contigs.groupBy("assembly_id").agg(F.sum("length").alias("total_bp"))


@query(
    "agg_3_alignment_summary",
    f"""+ {TOTALS}, k AS (SELECT * FROM alignments WHERE mapq >= 5), {sweep("k", "assembly_id, reference, contig", "qstart", "qend", "u")}, cov AS (SELECT assembly_id, reference, CAST(SUM(bp) AS BIGINT) AS covered_bp FROM u GROUP BY 1, 2),
    s AS (SELECT assembly_id, reference, COUNT(*) AS alignments, SUM(matches) AS m, SUM(block) AS b FROM k GROUP BY 1, 2)
    SELECT assembly_id, reference, alignments, covered_bp, ROUND(100.0 * covered_bp / CAST(total_bp AS DOUBLE), 6) AS query_percent, ROUND(100.0 * CAST(m AS DOUBLE) / CAST(b AS DOUBLE), 6) AS identity_percent FROM s JOIN cov USING (assembly_id, reference) JOIN totals USING (assembly_id)""",
    ("alignments", "contigs"),
)
def _(t):
    return A.alignment_summary(t.alignments, totals(t))


@query(
    "agg_13_callable_fraction",
    f"""+ {TOTALS}, p AS (SELECT * FROM alignments WHERE NOT is_secondary), q AS (SELECT * FROM p WHERE mapq >= 20 AND matches >= 0.95 * block AND block >= 2000),
    {sweep("p", "assembly_id, contig", "qstart", "qend", "pu")}, {sweep("q", "assembly_id, contig", "qstart", "qend", "qu")}, a AS (SELECT assembly_id, CAST(SUM(bp) AS BIGINT) AS primary_bp FROM pu GROUP BY 1), b AS (SELECT assembly_id, CAST(SUM(bp) AS BIGINT) AS callable_bp FROM qu GROUP BY 1)
    SELECT assembly_id, COALESCE(primary_bp, 0) AS primary_bp, COALESCE(callable_bp, 0) AS callable_bp, ROUND(COALESCE(primary_bp, 0) / CAST(total_bp AS DOUBLE), 6) AS primary_fraction, ROUND(COALESCE(callable_bp, 0) / CAST(total_bp AS DOUBLE), 6) AS callable_fraction
    FROM totals LEFT JOIN a USING (assembly_id) LEFT JOIN b USING (assembly_id)""",
    ("alignments", "contigs"),
)
def _(t):
    return A.callable_metrics(t.alignments, totals(t), 2000, 0.95, 20)


@query("jn_3_orphans", "SELECT c.assembly_id, c.contig FROM contigs c WHERE NOT EXISTS (SELECT 1 FROM nonhuman n WHERE n.assembly_id = c.assembly_id AND n.contig = c.contig AND n.identity >= 99)", ("contigs", "nonhuman"))
def _(t):
    return checks.orphans(t.contigs, t.nonhuman.filter("identity >= 99"), KEYS).select(*KEYS)


@query("jn_4_restrict", "SELECT n.assembly_id, n.contig, COUNT(*) AS hits FROM nonhuman n WHERE n.assembly_id || n.contig IN (SELECT assembly_id || contig FROM taxon_calls WHERE taxid = 2) GROUP BY 1, 2", ("nonhuman", "taxon_calls"))
def _(t):
    return checks.restrict(t.nonhuman, t.taxon_calls.filter("taxid = 2").select(*KEYS)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("hits"))


@query("jn_2_duplicate_keys", "SELECT assembly_id, contig, mapq, block, COUNT(*) AS n FROM alignments GROUP BY ALL HAVING COUNT(*) > 1", ("alignments",))
def _(t):
    return checks.duplicate_keys(t.alignments, [*KEYS, "mapq", "block"])


@query("win_8_best_per_key", "SELECT assembly_id, contig, qstart, mapq, block FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY assembly_id, contig ORDER BY mapq DESC, block DESC, qstart) AS r FROM alignments) WHERE r = 1", ("alignments",))
def _(t):
    return A.best_per_key(t.alignments, KEYS, [F.desc("mapq"), F.desc("block"), F.asc("qstart")]).select(*KEYS, "qstart", "mapq", "block")


@query(
    "agg_28_split_alignments",
    """+ o AS (SELECT aln_id // 100 AS read, string_agg(CAST(qstart AS STRING)||'-'||CAST(qend AS STRING), ';' ORDER BY qstart, qend, strand, reference, mapq) AS breakpoints, string_agg(strand, ';' ORDER BY qstart, qend, strand, reference, mapq) AS strands,
      COUNT(*) AS alignment_count, COUNT(DISTINCT strand) AS s, COUNT(DISTINCT reference) AS h FROM alignments WHERE NOT is_secondary GROUP BY 1 HAVING COUNT(*) > 1)
    SELECT read, CASE WHEN s > 1 AND h > 1 THEN 'POTENTIAL_INVERSION_OR_TRANSLOCATION' WHEN h > 1 THEN 'POTENTIAL_DISTANT_JOIN_OR_TRANSLOCATION' WHEN s > 1 THEN 'POTENTIAL_INVERSION_OR_COMPLEX' ELSE 'SPLIT_ALIGNMENT' END AS classification, alignment_count, breakpoints, strands FROM o""",
    ("alignments",),
)
def _(t):
    return A.split_alignments(t.alignments.withColumns({"read": F.expr("aln_id div 100"), "path_head": F.col("reference")}), ["read"])


@query(
    "win_5_visits",
    """+ v AS (SELECT assembly_id, contig, reference AS chunk, qstart, qend, CASE WHEN reference = LAG(reference) OVER w AND qstart <= LAG(qend) OVER w + 20000 THEN 0 ELSE 1 END AS f FROM alignments WHERE mapq >= 40 WINDOW w AS (PARTITION BY assembly_id, contig ORDER BY qstart, qend, reference)),
    g AS (SELECT *, SUM(f) OVER (PARTITION BY assembly_id, contig ORDER BY qstart, qend, chunk ROWS UNBOUNDED PRECEDING) AS g FROM v)
    SELECT assembly_id, contig, chunk, MIN(qstart) AS start, MAX(qend) AS end_, COUNT(*) AS alignments FROM g GROUP BY assembly_id, contig, g, chunk""",
    ("alignments",),
)
def _(t):
    return A.visits(t.alignments.filter("mapq >= 40").withColumn("chunk", F.col("reference")), KEYS, 20_000)


@query(
    "agg_11_long_read_metrics",
    f"""+ r AS (SELECT *, aln_id // 100 AS read_name FROM alignments), p AS (SELECT * FROM r WHERE NOT is_secondary), {sweep("p", "assembly_id, read_name", "qstart", "qend", "u")}, a AS (SELECT assembly_id, CAST(SUM(bp) AS BIGINT) AS aligned_bp FROM u GROUP BY 1),
    per AS (SELECT assembly_id, read_name, COUNT(*) FILTER (NOT is_secondary) AS p, COUNT(*) FILTER (is_secondary) AS s FROM r GROUP BY 1, 2),
    c AS (SELECT assembly_id, COUNT(*) FILTER (p > 0) AS mapped_reads, COUNT(*) FILTER (p > 1) AS split_reads, COUNT(*) FILTER (s > 0) AS multimapped_reads FROM per GROUP BY 1),
    q AS (SELECT assembly_id, ROUND(quantile_cont(CAST(qend - qstart AS DOUBLE), 0.1), 6) AS length_p10, ROUND(quantile_cont(CAST(qend - qstart AS DOUBLE), 0.5), 6) AS length_p50, ROUND(quantile_cont(CAST(qend - qstart AS DOUBLE), 0.9), 6) AS length_p90, ROUND(quantile_cont(CAST(mapq AS DOUBLE), 0.1), 6) AS mapq_p10, ROUND(quantile_cont(CAST(mapq AS DOUBLE), 0.5), 6) AS mapq_p50, ROUND(quantile_cont(CAST(mapq AS DOUBLE), 0.9), 6) AS mapq_p90 FROM r GROUP BY 1)
    SELECT * FROM c JOIN a USING (assembly_id) JOIN q USING (assembly_id)""",
    ("alignments",),
)
def _(t):
    return A.mapping_metrics_long(t.alignments.withColumn("read_name", F.expr("aln_id div 100")), ["assembly_id"])


def _bad(m: str, op: str, limit: float) -> str:
    return f"{m} {'<' if op == '>=' else '>'} {limit}"


def _reasons(kind: str) -> str:
    parts = []
    for m, op, n in qc.limits_on():
        cond = _bad(m, op, FAIL[n]) if kind == "fail" else f"NOT ({_bad(m, op, FAIL[n])}) AND {_bad(m, op, WARN[n])}"
        limit = FAIL[n] if kind == "fail" else WARN[n]
        parts.append(f"CASE WHEN {cond} THEN '{m}{op}{limit:g} (observed ' || printf('%.3f', CAST({m} AS DOUBLE)) || ')' END")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


STATUS = f"""st AS (SELECT *, CASE WHEN fail_reasons <> '' THEN 'FAIL' WHEN warning_reasons <> '' THEN 'WARN' ELSE 'PASS' END AS assembly_status FROM (SELECT *, {_reasons("fail")} AS fail_reasons, {_reasons("warn")} AS warning_reasons FROM assemblies))"""


def status(t: Tables) -> DataFrame:
    return qc.classify_thresholds(t.assemblies, FAIL, WARN)


@query("flt_1_threshold_rules", f"+ {STATUS} SELECT assembly_id, assembly_status, fail_reasons, warning_reasons FROM st", ("assemblies",))
def _(t):
    return status(t).select("assembly_id", "assembly_status", "fail_reasons", "warning_reasons")


DECISION = f"""+ {STATUS}, g AS (SELECT sample, COALESCE(MAX(CASE WHEN haplotype = 'hap1' THEN assembly_status END), 'MISSING') AS hap1_status, COALESCE(MAX(CASE WHEN haplotype = 'hap2' THEN assembly_status END), 'MISSING') AS hap2_status,
      COUNT(*) AS n, COUNT(*) FILTER (assembly_status = 'FAIL') AS f, COUNT(*) FILTER (assembly_status = 'WARN') AS w, string_agg(CASE WHEN assembly_status = 'FAIL' THEN haplotype || ': ' || fail_reasons END, '; ' ORDER BY haplotype) AS texts FROM st GROUP BY 1),
    d AS (SELECT *, CASE WHEN hap1_status = 'MISSING' THEN 'missing hap1' WHEN hap2_status = 'MISSING' THEN 'missing hap2' END AS missing FROM g),
    dec AS (SELECT sample, CASE WHEN missing IS NOT NULL OR f = n THEN 'FAIL' WHEN f > 0 THEN 'PARTIAL' WHEN w > 0 THEN 'WARN' ELSE 'PASS' END AS sample_status, hap1_status, hap2_status, concat_ws('; ', missing, texts) AS reasons, missing IS NOT NULL AS pair_error FROM d)"""


@query("flt_2_sample_decisions", DECISION + " SELECT sample, sample_status, hap1_status, hap2_status, reasons, pair_error FROM dec", ("assemblies",))
def _(t):
    return qc.sample_decisions(status(t))


@query("flt_2_included_assemblies", DECISION + " SELECT assembly_id, NOT pair_error AND assembly_status <> 'FAIL' AS included FROM st JOIN dec USING (sample)", ("assemblies",))
def _(t):
    s = status(t)
    return qc.split_inclusion(s, qc.sample_decisions(s)).select("assembly_id", "included")


@query(
    "jn_1_manifest",
    f"""+ {STATUS}, m AS (SELECT s.sample, s.haplotype, s.assembly_id, s.assembly_status, a.mash_distance, a.graph_member FROM st s LEFT JOIN assemblies a ON a.assembly_id = s.assembly_id)
    SELECT m.sample, m.haplotype, m.assembly_id, m.assembly_status, ROUND(m.mash_distance, 6) AS mash_distance, m.graph_member, o.assembly_id AS mate_id, COALESCE(o.assembly_status, 'MISSING') AS mate_status FROM m LEFT JOIN m o ON o.sample = m.sample AND o.haplotype <> m.haplotype""",
    ("assemblies",),
)
def _(t):
    return manifest(t)


def manifest(t: Tables) -> DataFrame:
    cleaned = status(t).select("sample", "haplotype", "assembly_id", "assembly_status")
    return qc.build_manifest(cleaned, t.assemblies.select("assembly_id", "mash_distance", "graph_member"))


RESCUE = """CASE WHEN assembly_status = 'PASS' AND graph_member THEN 'graph_control' WHEN assembly_status = 'PASS' THEN 'primary' WHEN assembly_status = 'WARN' THEN 'fragmented_rescue' ELSE 'not_recommended' END"""


@query(
    "flt_13_rescue_tier",
    f"""+ {STATUS}, r AS (SELECT assembly_id, sample, graph_member, {RESCUE} AS rescue_tier FROM st)
    SELECT assembly_id, rescue_tier, CAST(CASE rescue_tier WHEN 'primary' THEN 1 WHEN 'fragmented_rescue' THEN 2 WHEN 'graph_control' THEN 3 ELSE 4 END AS BIGINT) AS priority, CASE rescue_tier WHEN 'graph_control' THEN 'use as control' WHEN 'primary' THEN 'screen' WHEN 'fragmented_rescue' THEN 'request long reads' ELSE 'do not use' END AS required_action FROM r""",
    ("assemblies",),
)
def _(t):
    return qc.classify_rescue(manifest(t)).select("assembly_id", "rescue_tier", "priority", "required_action")


@query(
    "top_2_provisional_requests",
    f"""+ {STATUS}, r AS (SELECT sample, graph_member, {RESCUE} AS tier FROM st), p AS (SELECT *, CASE tier WHEN 'primary' THEN 1 WHEN 'fragmented_rescue' THEN 2 WHEN 'graph_control' THEN 3 ELSE 4 END AS pr FROM r),
    g AS (SELECT sample, COUNT(*) FILTER (tier IN ('fragmented_rescue', 'not_recommended') AND NOT graph_member) AS low_haplotypes, CAST(MIN(pr) AS BIGINT) AS priority FROM p GROUP BY 1)
    SELECT sample, low_haplotypes, priority, ROW_NUMBER() OVER (ORDER BY low_haplotypes DESC, priority, sample) AS request_rank FROM g WHERE low_haplotypes > 0""",
    ("assemblies",),
)
def _(t):
    return qc.provisional_requests(qc.classify_rescue(manifest(t)))


def contig_rows(t: Tables) -> DataFrame:
    return t.alignments.select("assembly_id", F.col("block").alias("length"), (F.col("block") % 7).alias("n_count"), F.expr("block * 2 div 5").alias("gc_count"))


@query(
    "agg_1_sequence_stats",
    """+ c AS (SELECT assembly_id, block AS length, block % 7 AS n_count, block * 2 // 5 AS gc_count FROM alignments), r AS (SELECT *, SUM(length) OVER (PARTITION BY assembly_id ORDER BY length DESC ROWS UNBOUNDED PRECEDING) AS run, SUM(length) OVER (PARTITION BY assembly_id) AS tot FROM c),
    h AS (SELECT assembly_id, MAX(length) AS n50 FROM r WHERE 2 * run >= tot GROUP BY 1)
    SELECT assembly_id, COUNT(*) AS contigs, CAST(SUM(length) AS BIGINT) AS total_bp, MAX(h.n50) AS n50, MAX(length) AS largest_bp, ROUND(100.0 * CAST(SUM(gc_count) AS DOUBLE) / CAST(SUM(length) AS DOUBLE), 6) AS gc_percent, CAST(SUM(n_count) AS BIGINT) AS n_bases, ROUND(100.0 * CAST(SUM(n_count) AS DOUBLE) / CAST(SUM(length) AS DOUBLE), 6) AS n_percent FROM c JOIN h USING (assembly_id) GROUP BY 1""",
    ("alignments",),
)
def _(t):
    return qc.sequence_stats(contig_rows(t))


@query("agg_2_n50", "+ r AS (SELECT assembly_id, contig, block, SUM(block) OVER (PARTITION BY assembly_id, contig ORDER BY block DESC ROWS UNBOUNDED PRECEDING) AS run, SUM(block) OVER (PARTITION BY assembly_id, contig) AS tot FROM alignments) SELECT assembly_id, contig, MAX(block) AS n50 FROM r WHERE 2 * run >= tot GROUP BY 1, 2", ("alignments",))
def _(t):
    return qc.n50(t.alignments, KEYS, "block")


@query(
    "agg_22_mash_outliers",
    """+ m AS (SELECT median(mash_distance) AS med FROM assemblies), d AS (SELECT median(abs(mash_distance - med)) AS mad FROM assemblies, m)
    SELECT assembly_id, ROUND(med, 6) AS median_distance, ROUND(mad, 6) AS mad, ROUND(CASE WHEN mad > 0 THEN (mash_distance - med) / mad ELSE 0 END, 6) AS mad_score, mash_distance > med + 3.5 * mad OR hash_fraction < 0.9 AS outlier FROM assemblies, m, d""",
    ("assemblies",),
)
def _(t):
    return qc.mash_outliers(t.assemblies).select("assembly_id", "median_distance", "mad", "mad_score", "outlier")


@query("agg_23_haplotype_pivot", "+ p AS (SELECT sample, MAX(CASE WHEN haplotype = 'hap1' THEN mash_distance END) AS hap1, MAX(CASE WHEN haplotype = 'hap2' THEN mash_distance END) AS hap2 FROM assemblies GROUP BY 1) SELECT sample, ROUND(hap1, 6) AS hap1, ROUND(hap2, 6) AS hap2, ROUND(abs(hap1 - hap2), 6) AS difference FROM p", ("assemblies",))
def _(t):
    return qc.haplotype_pivot(t.assemblies)


@query("win_6_task_batches", "+ r AS (SELECT assembly_id, ROW_NUMBER() OVER (ORDER BY graph_member DESC, sample, assembly_id) AS task_index FROM assemblies) SELECT assembly_id, task_index, 'batch_' || lpad(CAST((task_index - 1) // 16 + 1 AS STRING), 4, '0') AS batch_id FROM r", ("assemblies",))
def _(t):
    return qc.build_tasks(t.assemblies, 16, [F.desc("graph_member"), F.asc("sample"), F.asc("assembly_id")]).select("assembly_id", "task_index", "batch_id")


@query('win_16_build_order', """SELECT 'chm13' AS assembly_id, 1 AS "order" UNION ALL SELECT 'grch38', 2 UNION ALL SELECT assembly_id, 2 + ROW_NUMBER() OVER (ORDER BY mash_distance, assembly_id) FROM assemblies""", ("assemblies",))
def _(t):
    return qc.build_order(t.assemblies, ["chm13", "grch38"])


@query("scl_1_assembly_id", "SELECT assembly_id AS id, regexp_extract(assembly_id, '^(.+?)[.](hap[12])$', 1) AS sample, regexp_extract(assembly_id, '^(.+?)[.](hap[12])$', 2) AS haplotype FROM assemblies", ("assemblies",))
def _(t):
    return t.assemblies.select(F.col("assembly_id").alias("id"), C.parse_assembly_id(F.col("assembly_id")).alias("p")).select("id", "p.*")


@query("scl_2_normalize_assembly_id", "SELECT '/data/' || assembly_id || '.clean.fa.gz' AS path, assembly_id FROM assemblies", ("assemblies",))
def _(t):
    path = F.concat(F.lit("/data/"), F.col("assembly_id"), F.lit(".clean.fa.gz"))
    return t.assemblies.select(path.alias("path"), C.normalize_assembly_id(path).alias("assembly_id"))


# CIGARs: the adapter's pattern is aM bI cM dD eM; the oracle takes the five numbers apart
PARTS = """p AS (SELECT *, regexp_extract(cigar, '^(\\d+)M(\\d+)I(\\d+)M(\\d+)D(\\d+)M$', ['a', 'b', 'c', 'd', 'e']) AS x FROM cigars),
    n AS (SELECT aln_id, assembly_id, qstart, tstart, mapq, block, identity, is_primary, CAST(x.a AS BIGINT) AS a, CAST(x.b AS BIGINT) AS b, CAST(x.c AS BIGINT) AS c, CAST(x.d AS BIGINT) AS d, CAST(x.e AS BIGINT) AS e FROM p)"""
EVENTS = f"""+ {PARTS}, ev AS (
      SELECT n.*, 'atomic' AS kind, 'I' AS operation, b AS length, b AS svlen, qstart + a AS query_position, tstart + a AS target_position, CAST(1 AS BIGINT) AS members, a AS left_anchor, c + e AS right_anchor FROM n WHERE b >= 30
      UNION ALL SELECT n.*, 'atomic', 'D', d, -d, qstart + a + b + c, tstart + a + c, 1, a + c, e FROM n WHERE d >= 30
      UNION ALL SELECT n.*, 'cluster', 'ID', b + d, b - d, qstart + a, tstart + a, 2, a, e FROM n WHERE c <= 50 AND b + d >= 50)"""


@query("scl_6_parse_cigar", f"+ {PARTS} SELECT aln_id, CAST(5 AS BIGINT) AS operations, a + b + c + e AS query_bases, a + c + d + e AS target_bases FROM n", ("cigars",))
def _(t):
    ops = C.parse_cigar(F.col("cigar"))
    return t.cigars.select("aln_id", F.size(ops).alias("operations"), C.cigar_bases(ops, "MI=XS").alias("query_bases"), C.cigar_bases(ops, "MDN=X").alias("target_bases"))


def events(t: Tables) -> DataFrame:
    return A.cigar_events(t.cigars, keep=[c for c in t.cigars.columns if c not in ("cigar", "qstart", "tstart")])


@query("scl_7_cigar_events", EVENTS + " SELECT aln_id, kind, operation, length, svlen, query_position, target_position, members, left_anchor, right_anchor FROM ev", ("cigars",))
def _(t):
    return A.cigar_events(t.cigars, keep=["aln_id"]).select("aln_id", "kind", "operation", "length", "svlen", "query_position", "target_position", "members", "left_anchor", "right_anchor")


TIERED = (
    EVENTS
    + """, tr AS (SELECT *, concat_ws(';', CASE WHEN length < 50 THEN 'BELOW_50_BP_PENDING_NORMALIZATION' END, CASE WHEN NOT is_primary THEN 'SECONDARY_ALIGNMENT' END, CASE WHEN block < 5000 THEN 'SHORT_ALIGNMENT' END, CASE WHEN identity < 0.9 THEN 'LOW_IDENTITY' END, CASE WHEN mapq < 20 THEN 'LOW_MAPQ' END,
    CASE WHEN left_anchor < 1000 THEN 'WEAK_LEFT_ANCHOR' END, CASE WHEN right_anchor < 1000 THEN 'WEAK_RIGHT_ANCHOR' END, CASE WHEN left_anchor = 0 OR right_anchor = 0 THEN 'TERMINAL_EVENT_WITHOUT_SECOND_BREAKPOINT' END) AS reasons FROM ev),
    ti AS (SELECT *, CASE WHEN length < 50 THEN 'SENSITIVITY_SUBTHRESHOLD' WHEN reasons <> '' THEN 'REVIEW' ELSE 'HIGH_CONFIDENCE' END AS tier, CASE operation WHEN 'I' THEN 'INS' WHEN 'D' THEN 'DEL' ELSE 'COMPLEX_INDEL' END AS svtype FROM tr)"""
)


@query("flt_7_event_tiers", TIERED + " SELECT aln_id, kind, svtype, length, tier, reasons FROM ti", ("cigars",))
def _(t):
    return A.tier_events(events(t)).select("aln_id", "kind", "svtype", "length", "tier", "reasons")


@query(
    "agg_29_screen_summary",
    TIERED
    + """, s AS (SELECT assembly_id, COUNT(*) AS events, COUNT(*) FILTER (tier = 'HIGH_CONFIDENCE') AS high_confidence, COUNT(*) FILTER (tier = 'REVIEW') AS review FROM ti GROUP BY 1), k AS (SELECT DISTINCT assembly_id FROM cigars)
    SELECT assembly_id, COALESCE(events, 0) AS events, COALESCE(high_confidence, 0) AS high_confidence, COALESCE(review, 0) AS review, CASE WHEN high_confidence > 0 THEN 'CANDIDATE' WHEN events > 0 THEN 'RESIDUAL' ELSE 'SCREENED' END AS status FROM k LEFT JOIN s USING (assembly_id)""",
    ("cigars",),
)
def _(t):
    return A.screen_summary(A.tier_events(events(t)), t.cigars.select("assembly_id").distinct())


@query(
    "scl_21_aligned_bases",
    f"""+ {PARTS} SELECT aln_id, CAST(greatest(0, least(qstart + a, qstart + 2500) - greatest(qstart, qstart + 1000)) + greatest(0, least(qstart + a + b + c, qstart + 2500) - greatest(qstart + a + b, qstart + 1000)) + greatest(0, least(qstart + a + b + c + e, qstart + 2500) - greatest(qstart + a + b + c, qstart + 1000)) AS BIGINT) AS aligned FROM n""",
    ("cigars",),
)
def _(t):
    q = F.col("qstart")
    return t.cigars.select("aln_id", C.aligned_bases_in(C.parse_cigar(F.col("cigar")), q, F.lit("+"), q, q + 1000, q + 2500).alias("aligned"))


@query(
    "scl_22_event_discordance",
    f"""+ {PARTS} SELECT aln_id, CAST((CASE WHEN tstart + a BETWEEN tstart + 2080 - 30 AND tstart + 2100 + 30 THEN b ELSE 0 END) + (CASE WHEN tstart + a + c < tstart + 2130 AND tstart + a + c + d > tstart + 2050 THEN d ELSE 0 END) AS BIGINT) AS discordance FROM n""",
    ("cigars",),
)
def _(t):
    s = F.col("tstart")
    return t.cigars.select("aln_id", C.event_discordance(C.parse_cigar(F.col("cigar")), s, s + 2080, s + 2100, 30).alias("discordance"))


@query(
    "agg_12_linear_metrics",
    f"""+ {PARTS}, f AS (SELECT *, b + d + mapq % 7 AS nm, a + b + c + d + e AS bl FROM n WHERE is_primary)
    SELECT assembly_id, COUNT(*) AS primary_mapped, ROUND(AVG(mapq), 6) AS mean_mapq, ROUND(AVG((bl - nm) / CAST(bl AS DOUBLE)), 6) AS mean_identity, CAST(0 AS BIGINT) AS clipped_bases FROM f GROUP BY 1""",
    ("cigars",),
)
def _(t):
    ops = C.parse_cigar(F.col("cigar"))
    records = t.cigars.select("assembly_id", "mapq", "cigar", F.when(F.col("is_primary"), 0).otherwise(256).alias("flag"), (C.cigar_bases(ops, "ID") + F.col("mapq") % 7).alias("nm"))
    return A.mapping_metrics_linear(records, ["assembly_id"])
