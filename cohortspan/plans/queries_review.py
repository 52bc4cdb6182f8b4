"""Queries on imported calls, alleles and their places, provenance, cohorts of calls and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import alleles, annotate, calls, checks, cohort, compare, evidence, graph
from ..operators.components import saved
from .registry import Tables, query

# imported calls


@query(
    "scl_24_bubble_class",
    """+ b AS (SELECT *, greatest(abs(shortest - reference_length), abs(longest - reference_length)) AS difference FROM bubbles)
    SELECT n, difference, CASE WHEN bidirectional THEN 'INV_OR_COMPLEX' WHEN longest - reference_length >= 50 AND shortest - reference_length >= -49 THEN 'INS' WHEN shortest - reference_length <= -50 AND longest - reference_length <= 49 THEN 'DEL' ELSE 'MULTIALLELIC_OR_COMPLEX' END AS sv_class
    FROM b WHERE difference >= 50 OR bidirectional""",
    ("bubbles",),
)
def _(t):
    sizes = [F.col(c) for c in ("shortest", "longest", "reference_length")]
    return t.bubbles.select("n", C.bubble_difference(*sizes).alias("difference"), C.bubble_class(*sizes, F.col("bidirectional")).alias("sv_class")).filter("sv_class IS NOT NULL")


REPEATS = r"""rp AS (SELECT *, catalog_found AND chromosome = catalog_chromosome AND pos = catalog_start AND end_ = catalog_end AS u, string_split(gt, '/') AS g, string_split(repcn, '/') AS n, string_split(repci, '/') AS c FROM repeat_calls),
    r2 AS (SELECT *, try_cast(n[1] AS BIGINT) AS n1, CASE WHEN len(g) > 1 THEN try_cast(n[2] AS BIGINT) END AS n2, try_cast(string_split(c[1], '-')[1] AS BIGINT) AS l1, try_cast(string_split(c[1], '-')[2] AS BIGINT) AS h1,
      CASE WHEN len(g) > 1 THEN try_cast(string_split(c[2], '-')[1] AS BIGINT) END AS l2, CASE WHEN len(g) > 1 THEN try_cast(string_split(c[2], '-')[2] AS BIGINT) END AS h2 FROM rp),
    r3 AS (SELECT *, len(g) = len(n) AND len(g) = len(c) AND g[1] <> '.' AND coalesce(n1 BETWEEN l1 AND h1, false) AND (len(g) = 1 OR (g[2] <> '.' AND coalesce(n2 BETWEEN l2 AND h2, false))) AS whole FROM r2),
    r4 AS (SELECT *, CASE WHEN NOT catalog_found THEN 'NOT_IN_CATALOG' WHEN NOT u THEN 'CATALOG_COORDINATE_MISMATCH' WHEN filter IN ('LowDepth', 'q10;LowDepth') THEN 'LOW_DEPTH' WHEN NOT whole AND (n1 IS NOT NULL OR n2 IS NOT NULL) THEN 'PARTIAL_GENOTYPE'
      WHEN NOT whole THEN 'NO_CALL' WHEN filter <> 'PASS' THEN 'FILTERED_OR_UNASSESSED' ELSE 'CALLER_PASS' END AS call_status FROM r3)"""


@query(
    "scl_29_repeat_calls",
    f"""+ {REPEATS} SELECT file, variant, CASE WHEN u THEN len(g) END AS allele_count, CASE WHEN u THEN n1 END AS allele1_repeat_units, CASE WHEN u THEN l1 END AS allele1_ci_low, CASE WHEN u THEN h1 END AS allele1_ci_high,
      CASE WHEN u THEN n2 END AS allele2_repeat_units, CASE WHEN u THEN l2 END AS allele2_ci_low, CASE WHEN u THEN h2 END AS allele2_ci_high, call_status FROM r4""",
    ("repeat_calls",),
)
def _(t):
    sides = [f"allele{i}_{c}" for i in (1, 2) for c in ("repeat_units", "ci_low", "ci_high")]
    return calls.parse_repeat_calls(t.repeat_calls).select("file", "variant", "allele_count", *sides, "call_status")


FILE_STATUS = "CASE c_custkey % 12 WHEN 0 THEN 'VCF_UNAVAILABLE' WHEN 1 THEN 'NO_SAMPLE_HEADER' WHEN 2 THEN 'HEADER_ONLY_OR_TRUNCATED' ELSE 'READ' END"


@query(
    "jn_33_complete_repeat_calls",
    f"""+ {REPEATS}, fi AS (SELECT 'f' || c_custkey AS file, {FILE_STATUS} AS file_status FROM customer), se AS (SELECT DISTINCT variant, catalog_found FROM repeat_calls WHERE variant % 4 <> 3)
    SELECT fi.file, se.variant, coalesce(call_status, CASE WHEN file_status <> 'READ' THEN file_status WHEN NOT se.catalog_found THEN 'NOT_IN_CATALOG' ELSE 'RECORD_NOT_REPORTED' END) AS call_status
    FROM fi CROSS JOIN se LEFT JOIN (SELECT r4.* FROM r4 JOIN fi ON r4.file = fi.file WHERE file_status = 'READ') r ON r.file = fi.file AND r.variant = se.variant""",
    ("repeat_calls",),
)
def _(t):
    files = t.table("customer").select(F.concat(F.lit("f"), "c_custkey").alias("file"), F.expr(FILE_STATUS).alias("file_status"))
    selected = t.repeat_calls.filter("variant % 4 <> 3").select("variant", "catalog_found").distinct()
    read = calls.parse_repeat_calls(t.repeat_calls).join(files.filter("file_status = 'READ'").select("file"), "file", "left_semi")
    return calls.complete_repeat_calls(selected, files, read).select("file", "variant", "call_status")


SEGMENTS = r"""cs AS (SELECT *, CASE WHEN cn = '.' THEN 'MISSING_CN' WHEN alt IN ('<DEL>', '<DUP>') THEN 'REPORTED_CNV' WHEN alt = '.' AND gt IN ('0', '0/0', '0|0') THEN 'REPORTED_REFERENCE_SEGMENT' ELSE 'UNSUPPORTED_ALLELE_REPRESENTATION' END AS reported_state FROM cn_segments)"""


@query(
    "scl_30_cn_segments",
    f"""+ {SEGMENTS} SELECT file, record_id, pos - 1 AS start_0, end_, CASE WHEN alt = '<DEL>' THEN 'DEL' WHEN alt = '<DUP>' THEN 'DUP' WHEN reported_state = 'REPORTED_REFERENCE_SEGMENT' THEN 'REF' ELSE 'unknown' END AS svtype, reported_state, pos > 0 AND end_ >= pos AND cn <> '-1' AS valid FROM cs""",
    ("cn_segments",),
)
def _(t):
    return calls.classify_cn_segments(t.cn_segments).select("file", "record_id", "start_0", "end_", "svtype", "reported_state", "valid")


@query(
    "agg_51_import_status",
    f"""+ {SEGMENTS} SELECT file, COUNT(*) AS records, COUNT(*) FILTER (reported_state = 'REPORTED_REFERENCE_SEGMENT') AS reported_reference_segment, COUNT(*) FILTER (reported_state = 'REPORTED_CNV') AS reported_cnv, COUNT(*) FILTER (reported_state = 'MISSING_CN') AS missing_cn,
      COUNT(*) FILTER (reported_state = 'UNSUPPORTED_ALLELE_REPRESENTATION') AS unsupported_allele_representation FROM cs GROUP BY 1""",
    ("cn_segments",),
)
def _(t):
    return calls.import_status(calls.classify_cn_segments(t.cn_segments), "file", "reported_state", calls.SEGMENT_STATES)


# places on paths, capture

TOUCHED = """al AS (SELECT *, CASE WHEN path[1] IN ('>', '<') THEN regexp_extract_all(path, '[^><]+') ELSE [path] END AS k FROM path_alignments),
    s0 AS (SELECT aln_id, path[1] IN ('>', '<') AS g, unnest(k) AS node, generate_subscripts(k, 1) AS step FROM al),
    st AS (SELECT s0.*, ln, alias, q.event_id AS carried, novel, coalesce(sum(coalesce(ln, 0)) OVER (PARTITION BY aln_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s0 LEFT JOIN path_segments q ON node = segment_id),
    mt AS (SELECT aln_id, v.event_id, arg_min(before + CASE WHEN g THEN least(segment_offset, coalesce(ln, 0)) ELSE segment_offset END, step) AS coordinate FROM st JOIN path_events v ON graph_segment = node OR (g AND graph_segment = alias) GROUP BY 1, 2),
    nv AS (SELECT aln_id, bool_or(coalesce(novel, false)) AS a FROM st GROUP BY 1),
    tc AS (SELECT aln_id, event_id, CAST(max(coordinate) AS BIGINT) AS coordinate, bool_or(alternate) AS alternate FROM (SELECT aln_id, event_id, coordinate, a AS alternate FROM mt JOIN nv USING (aln_id) UNION ALL SELECT aln_id, carried, NULL, true FROM st WHERE carried IN (SELECT event_id FROM path_events)) GROUP BY 1, 2)"""
PATHS = ("path_alignments", "path_events", "path_segments")


def touched(t: Tables) -> DataFrame:
    return alleles.path_event_coordinate(t.path_alignments, t.path_events, t.path_segments)


@query("jn_13_path_event_coordinate", f"+ {TOUCHED} SELECT * FROM tc", PATHS)
def _(t):
    return touched(t)


ROLES = ((19, "rescue_source"), (18, "independent_carrier"), (13, "noncarrier_control"))
CAPTURE = f"""{TOUCHED}, ev AS (SELECT event_id, sample_id, COUNT(*) AS m, COUNT(*) FILTER (is_secondary) AS s, COUNT(*) FILTER (NOT is_secondary AND tstart <= coordinate - 200 AND tend >= coordinate + 200) AS b, COUNT(*) FILTER (NOT is_secondary AND alternate) AS a,
      median(CASE WHEN NOT is_secondary THEN max_indel END) AS i, median(CASE WHEN NOT is_secondary THEN clip END) AS c FROM path_alignments JOIN tc USING (aln_id) GROUP BY 1, 2),
    ro AS (SELECT event_id, 'S' || ((n + d) % 20) AS sample_id, role FROM path_events, (VALUES {", ".join(f"({d}, '{r}')" for d, r in ROLES)}) x(d, role)),
    cp AS (SELECT event_id, sample_id, role, coalesce(m, 0) AS m, coalesce(s, 0) AS s, coalesce(b, 0) AS b, coalesce(a, 0) AS a, i, c, coalesce(b > 0 AND a > 0, false) AS cap FROM ro LEFT JOIN ev USING (event_id, sample_id)),
    cq AS (SELECT *, CASE WHEN m > 0 THEN s / CAST(m AS DOUBLE) ELSE 0.0 END AS f, bool_or(cap AND role = 'independent_carrier') OVER (PARTITION BY event_id) AS rep FROM cp),
    cr AS (SELECT *, CASE WHEN f > 0.5 THEN 'ambiguous_repetitive' WHEN cap THEN 'captured_in_V2' ELSE 'not_captured' END AS capture_status FROM cq)"""


@query(
    "agg_43_rescue_capture",
    f"""+ {CAPTURE} SELECT event_id, sample_id, role, m AS mapped_records, s AS secondary_records, b AS both_anchor_records, a AS alternate_traversal_records, ROUND(i, 6) AS median_max_indel_bp, ROUND(c, 6) AS median_clipped_bp, ROUND(f, 6) AS secondary_fraction, capture_status,
      CASE WHEN capture_status <> 'captured_in_V2' THEN capture_status WHEN rep THEN 'independently_replicated' ELSE 'source_only_evidence' END AS replication_status FROM cr""",
    PATHS,
)
def _(t):
    found = alleles.rescue_capture(t.path_alignments, touched(t), ["sample_id"], 200)
    role = F.explode(F.array(*(F.struct(F.lit(d).alias("d"), F.lit(r).alias("role")) for d, r in ROLES)))
    roles = t.path_events.select("event_id", "n", role.alias("r")).select("event_id", F.concat(F.lit("S"), (F.col("n") + F.col("r.d")) % 20).alias("sample_id"), "r.role")
    return alleles.capture_status(roles, found)


PLAN = "substr(contig, 4)"


@query(
    "agg_49_seed_read_support",
    f"""+ p AS (SELECT *, tstart + block AS tend, 'r' || (aln_id // 20) AS read_name, CAST({PLAN} AS BIGINT) * 40000 AS ev, aln_id % 60 AS discordance FROM alignments), q AS (SELECT *, mapq >= 20 AND block >= 1000 AND NOT is_secondary AS ok FROM p), z AS (SELECT *, ok AND tstart <= greatest(ev - 200, 0) AND tend >= ev + 300 AS sp FROM q)
    SELECT assembly_id, contig, COUNT(DISTINCT CASE WHEN ok THEN read_name END) AS selected, COUNT(DISTINCT CASE WHEN sp THEN read_name END) AS spanning, COUNT(DISTINCT CASE WHEN sp AND discordance <= 30 THEN read_name END) AS supporting FROM z GROUP BY 1, 2""",
    ("alignments",),
)
def _(t):
    at = F.expr(f"CAST({PLAN} AS BIGINT) * 40000")
    paf = t.alignments.withColumns({"tend": F.col("tstart") + F.col("block"), "read_name": F.expr("'r' || (aln_id div 20)"), "left_anchor": at - 200, "right_anchor": at + 300, "discordance": F.col("aln_id") % 60})
    return evidence.seed_read_support(paf, ["assembly_id", "contig"])


@query(
    "jn_25_simulated_accuracy",
    """+ b AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY assembly_id, read_name ORDER BY mapq DESC, block DESC, path DESC, tstart DESC, qstart DESC) AS r FROM simulated WHERE NOT is_secondary) WHERE r = 1),
    c AS (SELECT *, CASE WHEN a % 4 = 1 THEN (o + a) % 5 = o % 5 ELSE true END AS same, ts + block + 10000 >= (o*53) % 2000000 AND ts - 10000 <= (o*53) % 2000000 + 15000 AS hit, contains(path, 'S' || (o % 50)) AS sa, contains(path, 'hap' || (o % 2)) AS ha FROM b)
    SELECT assembly_id, COUNT(*) AS reads_assessed, ROUND(AVG(CAST(same AS DOUBLE)), 6) AS correct_chromosome_fraction, ROUND(AVG(CAST(same AND hit AS DOUBLE)), 6) AS correct_locus_fraction, ROUND(AVG(CAST(NOT (same AND hit) AS DOUBLE)), 6) AS wrong_locus_fraction,
      ROUND(COUNT(*) FILTER (sa AND ha) / CAST(nullif(COUNT(*) FILTER (sa OR ha), 0) AS DOUBLE), 6) AS correct_haplotype_fraction, COUNT(*) FILTER (sa OR ha) AS haplotype_assessable_reads, ROUND(AVG(matches / CAST(block AS DOUBLE)), 6) AS mean_identity,
      ROUND(AVG((qend - qstart) / 15000.0::DOUBLE), 6) AS mean_aligned_fraction, ROUND(AVG((qstart + qlen - qend) / 15000.0::DOUBLE), 6) AS mean_clipped_fraction FROM c GROUP BY 1""",
    ("simulated",),
)
def _(t):
    return compare.simulated_accuracy(t.simulated.drop("o", "ts", "a"), ["assembly_id"])


@query(
    "jn_31_placement_review",
    """+ h AS (SELECT f.feature_id AS query_id, p.query_id IS NOT NULL AS hit, p.chromosome = f.chromosome AND tstart <= end_ + 1000 AND tend >= greatest(start - 1000, 0) AS near, qstart <= 100 AND qend >= qlen - 100 AND mapq >= 20 AND mapq < 255 AS whole FROM features f LEFT JOIN placements p ON p.query_id = f.feature_id)
    SELECT query_id, COUNT(*) FILTER (hit) AS hits, COUNT(*) FILTER (near) AS local_hits, COUNT(*) FILTER (near AND whole) AS spanning_hits, CASE WHEN COUNT(*) FILTER (near AND whole) > 0 THEN 'REVIEW_ALIGNMENT' ELSE 'UNRESOLVED_PLACEMENT' END AS placement_status FROM h GROUP BY 1""",
    ("features", "placements"),
)
def _(t):
    return annotate.placement_review(t.features.select(F.col("feature_id").alias("query_id"), "chromosome", "start", "end_"), t.placements)


# graphs


@query(
    "jn_24_translate_edges",
    """+ tr AS (SELECT segment_id, CASE n % 3 WHEN 0 THEN [3*n] WHEN 1 THEN [3*n, 3*n + 1] ELSE [3*n, 3*n + 1, 3*n + 2] END AS nodes FROM segments WHERE n % 40 <> 7)
    SELECT left_id || '|' || right_id AS edge_id, CASE WHEN left_forward THEN '>' ELSE '<' END || left_id AS left_token, '>' || right_id AS right_token,
      CASE WHEN left_forward THEN '>' || a.nodes[-1] ELSE '<' || a.nodes[1] END AS left_node, '>' || b.nodes[1] AS right_node FROM links LEFT JOIN tr a ON a.segment_id = left_id LEFT JOIN tr b ON b.segment_id = right_id""",
    ("segments", "links"),
)
def _(t):
    targets = t.links.selectExpr("left_id || '|' || right_id AS edge_id", "IF(left_forward, '>', '<') || left_id AS left_token", "'>' || right_id AS right_token")
    translation = t.segments.filter("n % 40 <> 7").selectExpr("segment_id", "CASE n % 3 WHEN 0 THEN array(3*n) WHEN 1 THEN array(3*n, 3*n + 1) ELSE array(3*n, 3*n + 1, 3*n + 2) END AS nodes")
    return graph.translate_edges(targets, translation)


def records(t: Tables) -> DataFrame:
    links = t.links.select(F.lit("L").alias("record_type"), F.lit(0).cast("long").alias("length"), "sr")
    return t.segments.select(F.lit("S").alias("record_type"), F.col("ln").alias("length"), "sr").unionByName(links)


INVENTORY = "re AS (SELECT 'S' AS t, ln, sr FROM segments UNION ALL SELECT 'L', 0, sr FROM links), n AS (SELECT COUNT(*) FILTER (t = 'S') AS segments, COUNT(*) FILTER (t = 'L') AS links, 0 AS paths, coalesce(SUM(ln), 0) AS segment_bp, COUNT(*) FILTER (t = 'S' AND sr < 2) AS s0, COUNT(*) FILTER (t = 'L' AND sr < 2) AS l0, coalesce(SUM(ln) FILTER (sr < 2), 0) AS b0 FROM re)"


@query(
    "agg_21_graph_inventory",
    f"""+ {INVENTORY} SELECT metric, CAST(value AS BIGINT) AS value FROM (SELECT unnest(['source_segments', 'source_links', 'source_paths', 'source_segment_bp', 'final_segments', 'final_links', 'final_paths', 'final_segment_bp', 'delta_segments', 'delta_links', 'delta_paths', 'delta_segment_bp']) AS metric,
      unnest([s0, l0, 0, b0, segments, links, paths, segment_bp, segments - s0, links - l0, 0, segment_bp - b0]) AS value FROM n)""",
    ("segments", "links"),
)
def _(t):
    return graph.inventory_delta(records(t).filter("sr < 2"), records(t))


# alleles


def flat(t: Tables) -> DataFrame:
    """Sequences in five letters only."""
    return t.sequences.select("contig", F.regexp_replace("seq", "[^ACGTN]", "N").alias("seq"))


FLAT = "fl AS (SELECT contig, regexp_replace(coalesce(seq, ''), '[^ACGTN]', 'N', 'g') AS seq FROM sequences)"
ALLELE = "CASE WHEN contig % 7 = 0 THEN 'ACGT' ELSE substr(seq, 5, 12) || 'ACG' END"
RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
PLACED = f"{FLAT}, pl AS (SELECT contig, seq, 60 + contig % 50 AS loc, {ALLELE} AS allele FROM fl), so AS (SELECT *, substr(seq, 1, loc) || allele || substr(seq, loc + 1) AS s FROM pl), sp AS (SELECT *, CASE WHEN contig % 3 = 1 THEN {RC.format('s')} ELSE s END AS source, CASE WHEN contig % 3 = 1 THEN length(s) - loc - length(allele) ELSE loc END + CASE WHEN contig % 5 = 0 THEN 1 ELSE 0 END AS off FROM so)"
BUILT = f"""{PLACED}, wi AS (SELECT *, CASE WHEN loc >= 40 AND loc + 40 <= length(seq) THEN substr(seq, loc - 39, 80) END AS ref, CASE WHEN off >= 40 AND off + length(allele) + 40 <= length(source) THEN substr(source, off - 39, length(allele) + 80) END AS seen FROM sp),
    ce AS (SELECT *, substr(seen, 41, length(allele)) = allele AS same, {RC.format('substr(seen, 41, length(allele))')} = allele AS turned, CASE WHEN contig % 14 = 0 THEN CASE WHEN contig % 4 = 0 THEN '-' ELSE '+' END END AS review FROM wi),
    bu AS (SELECT *, CASE WHEN ref IS NULL THEN 'REFERENCE_FLANKS_MISSING_TRUNCATED_OR_INVALID' WHEN seen IS NULL THEN 'SOURCE_FASTA_CONTIG_OR_COMPLETE_FLANKS_UNAVAILABLE' WHEN same AND turned AND review IS NULL THEN 'PALINDROMIC_INSERTION_ORIENTATION_REQUIRES_FLANK_REVIEW'
      WHEN NOT same AND NOT turned THEN 'SOURCE_OFFSET_INSERTION_SEQUENCE_DISAGREEMENT' END AS bad, CASE WHEN same AND turned THEN review WHEN same THEN '+' ELSE '-' END AS o FROM ce),
    bt AS (SELECT *, CASE WHEN bad IS NULL THEN CASE WHEN o = '-' THEN {RC.format('seen')} ELSE seen END END AS alt FROM bu),
    ok AS (SELECT *, left(alt, 40) = left(ref, 40) AND right(alt, 40) = right(ref, 40) AS exact FROM bt)"""


def built(t: Tables) -> DataFrame:
    placed = flat(t).fillna("", ["seq"]).selectExpr("contig", "seq", "60 + contig % 50 AS loc", f"{ALLELE} AS allele").selectExpr("*", "substr(seq, 1, loc) || allele || substr(seq, loc + 1) AS s")
    turned = C.reverse_complement(F.col("s"))
    sources = placed.withColumn("source", F.when(F.col("contig") % 3 == 1, turned).otherwise(F.col("s")))
    offset = F.expr("CASE WHEN contig % 3 = 1 THEN length(s) - loc - length(allele) ELSE loc END + CASE WHEN contig % 5 = 0 THEN 1 ELSE 0 END")
    # places and alleles of all texts, without the texts: written once, since they are read four times
    candidates = saved(sources.select(F.col("contig").alias("candidate_id"), F.col("contig").alias("chromosome"), F.col("loc").alias("position"), F.col("contig").alias("source_contig"), offset.alias("source_offset"), "allele"))
    review = placed.filter("contig % 14 = 0").selectExpr("contig AS candidate_id", "IF(contig % 4 = 0, '-', '+') AS orientation")
    return alleles.reconstruct_alleles(candidates, flat(t), sources.selectExpr("contig", "source AS seq"), review, 40)


@query(
    "jn_28_reconstruct_alleles",
    f"""+ {BUILT} SELECT contig AS candidate_id, loc AS position, off AS source_offset, allele, CASE WHEN bad IS NULL THEN o END AS source_orientation, CASE WHEN bad IS NULL THEN ref END AS reference_seq, alt AS alternate_seq,
      CASE WHEN bad IS NOT NULL THEN 'REJECTED' WHEN exact THEN 'PASS' ELSE 'SOURCE_INSERT_CONFIRMED_ANCHORS_PENDING' END AS status, coalesce(bad, CASE WHEN exact THEN 'EXACT_SOURCE_AND_REFERENCE_ANCHORS' ELSE 'REVIEW_SOURCE_FLANK_PLACEMENT' END) AS reason FROM ok""",
    ("sequences",),
)
def _(t):
    return built(t).drop("chromosome", "source_contig")


@query("jn_28_distinct_alleles", f"+ {BUILT} SELECT contig AS chromosome, loc AS position, sha256(ref) AS reference_sha256, sha256(allele) AS allele_sha256, CAST(contig AS STRING) AS candidate_ids, 1 AS candidates FROM ok WHERE bad IS NULL", ("sequences",))
def _(t):
    return alleles.distinct_alleles(built(t))


VARIANT = "CASE WHEN contig % 6 = 0 THEN 'TTTT' ELSE substr(seq, 31 + contig % 20, 4) END"


@query(
    "jn_30_allele_queries",
    f"""+ {FLAT}, va AS (SELECT *, 30 + contig % 20 AS loc, {VARIANT} AS ref FROM fl WHERE contig % 3 <> 2), ro AS (SELECT *, unnest(CASE WHEN contig % 4 = 0 THEN [0, 1, 3] ELSE [0, 1] END) AS alt_index FROM va),
    q AS (SELECT *, CASE WHEN loc + length(ref) + 20 > length(seq) THEN 'FLANKS_MISSING' WHEN substr(seq, loc + 1, length(ref)) <> ref THEN 'REF_MISMATCH' WHEN alt_index = 3 THEN 'ALT_ABSENT' ELSE 'BUILT' END AS status, CASE alt_index WHEN 0 THEN ref ELSE 'AC' END AS a FROM ro)
    SELECT contig, 101 + loc AS pos, 'v' || contig AS variant_id, alt_index, status, CASE WHEN status = 'BUILT' THEN substr(seq, loc - 19, 20) || a || substr(seq, loc + length(ref) + 1, 20) END AS query_seq, CASE WHEN status = 'BUILT' THEN 20 END AS allele_start, CASE WHEN status = 'BUILT' THEN 20 + length(a) END AS allele_end FROM q""",
    ("sequences",),
)
def _(t):
    rows = flat(t).fillna("", ["seq"]).selectExpr("contig", "131 + contig % 20 AS pos", "'v' || contig AS variant_id", f"{VARIANT} AS ref", "array('AC', 'GTT') AS alts")
    wanted = rows.filter("contig % 3 <> 2").select("contig", "pos", "variant_id", F.explode(F.expr("IF(contig % 4 = 0, array(1, 3), array(1))")).alias("alt_index"))
    return alleles.build_allele_queries(rows, wanted, flat(t), 100, 20)


NODE = "repeat('ACGGT', CAST(1 + p_partkey % 7 AS INT)) || CASE WHEN p_partkey % 3 = 0 THEN 'AA' ELSE 'C' END"
MANIFEST = "SELECT 'S' || CAST(c_custkey {d} 2 AS STRING) AS sample, 'S' || CAST(c_custkey {d} 2 AS STRING) || '.hap' || CAST(1 + c_custkey % 2 AS STRING) || '.clean' AS assembly_id, (c_custkey % 2) * 1000000 + c_custkey AS ordinal FROM {customer}"


@query(
    "jn_26_correct_provenance",
    f"""WITH ma AS ({MANIFEST.format(d="//", customer="customer")}), od AS (SELECT *, 9 + ROW_NUMBER() OVER (ORDER BY f, ordinal) AS sr FROM (SELECT *, MIN(ordinal) OVER (PARTITION BY sample) AS f FROM ma)),
    ca AS (SELECT p_partkey AS p, 5 + p_partkey % 120 AS sr, CASE WHEN p_partkey % 13 = 0 THEN 'other' ELSE 'S' || ((p_partkey % 120 - 5) // 2) || '.hap' || (1 + (p_partkey % 120 + 1) % 2) END || '.ctg' AS sn, {NODE} AS seq, p_partkey % 19 <> 4 AS has FROM part),
    bb AS (SELECT p, CASE p % 4 WHEN 0 THEN seq WHEN 1 THEN {RC.format("seq")} WHEN 2 THEN CASE WHEN p % 8 = 2 THEN seq || 'A' ELSE seq END ELSE seq END AS b FROM ca WHERE p % 9 <> 0 UNION ALL SELECT p, seq FROM ca WHERE p % 17 = 0 AND p % 9 <> 0),
    n AS (SELECT p, COUNT(*) AS n, MIN(b) AS b FROM bb GROUP BY 1),
    al AS (SELECT ca.*, od.sample, od.assembly_id, coalesce(CASE WHEN has THEN n.n END, 0) AS bubbles, n.b FROM ca LEFT JOIN od ON od.sr = ca.sr AND has LEFT JOIN n USING (p)),
    st AS (SELECT *, CASE WHEN NOT has THEN 'NODE_MISSING' WHEN assembly_id IS NULL THEN 'RANK_OUTSIDE_BUILD_ORDER' WHEN NOT starts_with(sn, replace(assembly_id, '.clean', '') || '.') THEN 'SOURCE_NAME_DISAGREES' WHEN bubbles = 0 THEN 'BUBBLE_MISSING' WHEN bubbles > 1 THEN 'SEVERAL_BUBBLES' WHEN b <> seq AND b <> {RC.format("seq")} THEN 'BUBBLE_SEQUENCE_DIFFERS' ELSE 'PASS' END AS provenance_status FROM al)
    SELECT p AS candidate_id, CASE WHEN has THEN sr END AS sr, sample AS donor_sample, assembly_id AS donor_assembly, CASE WHEN has THEN bubbles ELSE coalesce((SELECT n.n FROM n WHERE n.p = st.p), 0) END AS bubbles, provenance_status, CASE WHEN provenance_status = 'PASS' THEN sha256(b) END AS sequence_sha256 FROM st""",
)
def _(t):
    part = t.table("part").selectExpr("p_partkey AS p", "5 + p_partkey % 120 AS sr", "IF(p_partkey % 13 = 0, 'other', 'S' || CAST(floor((p_partkey % 120 - 5) / 2) AS BIGINT) || '.hap' || (1 + (p_partkey % 120 + 1) % 2)) || '.ctg' AS sn", f"{NODE} AS seq")
    manifest = t.spark.sql(MANIFEST.replace("{d}", "div"), customer=t.table("customer"))
    candidates = part.selectExpr("p AS candidate_id", "'s' || p AS node_id", "'chr1' AS chromosome", "p * 10 AS position")
    segments = part.filter("p % 19 <> 4").selectExpr("'s' || p AS segment_id", "sn", "sr", "seq")
    spelled = F.when(F.col("p") % 4 == 1, C.reverse_complement(F.col("seq"))).when(F.col("p") % 8 == 2, F.concat("seq", F.lit("A"))).otherwise(F.col("seq"))
    nodes = F.expr("IF(p % 9 = 0, array('a', 'b'), array('a', 's' || p, 'b'))").alias("nodes")
    place = (F.lit("chr1").alias("chromosome"), (F.col("p") * 10).alias("start"), nodes)
    bubbles = part.select(*place, spelled.alias("seq")).unionByName(part.filter("p % 17 = 0").select(*place, "seq"))
    return alleles.correct_provenance(manifest, candidates, segments, bubbles, 10).drop("node_id", "chromosome", "position")


# cohorts and reports

CROSSWALK = "SELECT feature_id AS locus_id, CASE n % 3 WHEN 0 THEN 'GRCh38' WHEN 1 THEN 'CHM13' ELSE 'other' END AS build, chromosome, start, end_ FROM features"


@query(
    "jn_27_counterpart_rows",
    f"+ x AS ({CROSSWALK}) SELECT *, 'NATIVE' AS coordinate_status FROM x UNION ALL SELECT locus_id, CASE WHEN build = 'GRCh38' THEN 'CHM13' ELSE 'GRCh38' END, NULL, NULL, NULL, 'UNRESOLVED' FROM x",
    ("features",),
)
def _(t):
    return annotate.counterpart_rows(t.spark.sql(CROSSWALK.replace("FROM features", "FROM {features}"), features=t.features))


@query(
    "jn_21_validate_concordance",
    """+ x AS (SELECT *, status <> 'UNRESOLVED' AND callable = 'yes' AND o % 11 <> 3 AS e, o % 11 <> 3 AS k FROM cells WHERE allele_id IN (SELECT DISTINCT 'A' || (o_orderkey % 20) FROM orders)),
    g AS (SELECT validation_set, COUNT(*) AS n, COUNT(*) FILTER (e) AS a, COUNT(*) FILTER (e AND truth = carrier_status) AS b, COUNT(*) FILTER (e AND (truth = 'ALT_SUPPORTED' OR carrier_status = 'ALT_SUPPORTED')) AS c, COUNT(*) FILTER (e AND truth = 'ALT_SUPPORTED' AND carrier_status = 'ALT_SUPPORTED') AS d FROM x GROUP BY 1)
    SELECT validation_set, 'all_resolved' AS scope, n AS attempted, a AS evaluable, b AS concordant, n - a AS no_call FROM g UNION ALL SELECT validation_set, 'nonreference_union', n, c, d, n - a FROM g""",
    ("cells",),
)
def _(t):
    panel = t.table("orders").select(F.concat(F.lit("A"), F.col("o_orderkey") % 20).alias("allele_id")).distinct()
    truth = t.cells.select("person_id", "allele_id", "status", "truth", "validation_set")
    short = t.cells.filter("o % 11 <> 3").select("person_id", "allele_id", (F.col("callable") == "yes").alias("callable"), F.col("carrier_status").alias("short_call"))
    return evidence.validate_concordance(panel, t.people.select("person_id"), truth, short)


MODES = {"sex_aware": "CASE WHEN caller = 'dipcall' THEN '' ELSE '^chr[XY]$' END", "autosomes_only": "'^chr[XY]$'"}


@query(
    "jn_32_call_manifest",
    f"""+ p AS (SELECT sample FROM assemblies GROUP BY 1 HAVING COUNT(DISTINCT haplotype) = 2), g AS (SELECT * FROM p, (VALUES ('GRCh38'), ('CHM13')) a(coordinate_system), (VALUES ('dipcall'), ('pav')) b(caller))
    {" UNION ALL ".join(f"SELECT *, {e} AS exclude_contig_regex, '{m}' AS sex_mode FROM g" for m, e in MODES.items())}""",
    ("assemblies",),
)
def _(t):
    one, two = (cohort.call_manifest(t.assemblies, ["GRCh38", "CHM13"], ["dipcall", "pav"], m, "^chr[XY]$").withColumn("sex_mode", F.lit(m)) for m in MODES)
    return one.unionByName(two)


@query("jn_32_paired_samples", "SELECT sample, COUNT(DISTINCT haplotype) = 2 AS paired FROM assemblies GROUP BY 1", ("assemblies",))
def _(t):
    return cohort.paired_samples(t.assemblies)


NAMES = {"query_name": "'id=' || assembly_id || '|' || contig_id", "original_name": "assembly_id || '|' || string_split(original_header, ' ')[1]", "panel_name": "panel_name"}


@query(
    "jn_34_check_crosswalk",
    f"""+ g AS (SELECT k.assembly_id, COUNT(*) AS n, SUM(length) AS bp, COUNT(*) FILTER (NOT coalesce(starts_with(panel_name, m.sample || '#1#'), false)) AS bad, COUNT(*) FILTER (length = 0) AS short FROM crosswalk_contigs k LEFT JOIN crosswalk_manifest m USING (assembly_id) GROUP BY 1),
    j AS (SELECT coalesce(m.assembly_id, g.assembly_id) AS assembly_id, m.assembly_id IS NOT NULL AS listed, coalesce(contig_count, 0) AS cc, coalesce(total_bases, 0) AS tb, coalesce(n, 0) AS n, coalesce(bp, 0) AS bp, coalesce(bad, 0) AS bad, coalesce(short, 0) AS short FROM crosswalk_manifest m FULL JOIN g USING (assembly_id)),
    u AS (SELECT assembly_id, 'listed' AS "check", 1 AS expected, CAST(listed AS BIGINT) AS found FROM j UNION ALL SELECT assembly_id, 'contig_count', cc, n FROM j UNION ALL SELECT assembly_id, 'total_bases', tb, bp FROM j UNION ALL SELECT assembly_id, 'name_prefix', 0, bad FROM j UNION ALL SELECT assembly_id, 'empty_contig', 0, short FROM j)
    SELECT * FROM u WHERE expected <> found UNION ALL SELECT MIN(assembly_id), k, 1, COUNT(*) FROM ({" UNION ALL ".join(f"SELECT assembly_id, '{k}' AS k, {e} AS name FROM crosswalk_contigs" for k, e in NAMES.items())}) GROUP BY k, name HAVING COUNT(*) > 1""",
    ("crosswalk_contigs", "crosswalk_manifest"),
)
def _(t):
    return checks.check_crosswalk(t.crosswalk_contigs, t.crosswalk_manifest)


@query(
    "agg_47_coverage_report",
    """+ i AS (SELECT assembly_id, SUM(qend - qstart) AS r, COUNT(*) AS n FROM alignments WHERE mapq >= 40 AND reference = 'ref1' AND assembly_id <> 'asm3' GROUP BY 1)
    SELECT CAST(substr(assembly_id, 4) AS BIGINT) AS ordinal, assembly_id AS sample, b AS input_bases, coalesce(r, 0) AS represented_bases, b - coalesce(r, 0) AS excluded_unaligned_bases, coalesce(n, 0) AS intervals FROM (SELECT assembly_id, SUM(length) AS b FROM contigs GROUP BY 1) LEFT JOIN i USING (assembly_id)""",
    ("alignments", "contigs"),
)
def _(t):
    samples = t.contigs.groupBy("assembly_id").agg(F.sum("length").alias("input_bases")).selectExpr("CAST(substr(assembly_id, 4) AS BIGINT) AS ordinal", "assembly_id AS sample", "input_bases")
    plan = t.alignments.filter("mapq >= 40 AND reference = 'ref1' AND assembly_id <> 'asm3'").selectExpr("assembly_id AS sample", "qstart AS start", "qend AS end_")
    return cohort.coverage_report(samples, plan)


@query(
    "agg_48_exclusion_ledger",
    """+ a AS (SELECT person_id, consent AS status, 'consent' AS reason FROM people WHERE consent <> 'yes'), b AS (SELECT allele_id, callable, person_id, status FROM cells WHERE callable <> 'yes')
    SELECT 'exclusions' AS source_table, 'sample' AS entity, person_id AS identifier, status, reason, CAST(to_json({'person_id': person_id, 'reason': reason, 'status': status}) AS VARCHAR) AS source_record_json FROM a
    UNION ALL SELECT 'evidence', 'sample_allele', allele_id, status, '', CAST(to_json({'allele_id': allele_id, 'callable': callable, 'person_id': person_id, 'status': status}) AS VARCHAR) FROM b""",
    ("people", "cells"),
)
def _(t):
    blocked = t.people.filter("consent <> 'yes'").selectExpr("person_id", "consent AS status", "'consent' AS reason")
    return cohort.exclusion_ledger(("exclusions", "sample", "person_id", blocked), ("evidence", "sample_allele", "allele_id", t.cells.select("person_id", "allele_id", "callable", "status")))


STAGE_ROWS = "CAST(o_custkey AS STRING) AS stage, CASE WHEN o_custkey % 3 = 0 THEN 'COMPLETED' WHEN o_custkey % 7 = 0 THEN 'SKIPPED' WHEN o_orderkey % 29 = 0 THEN 'FAILED' ELSE 'ESTIMATED' END AS status, o_orderkey % 31 <> 0 AND o_custkey % 10 <> 9 AS available"


@query(
    "agg_48_status_snapshot",
    f"""WITH r AS (SELECT {STAGE_ROWS} FROM orders), g AS (SELECT stage, coalesce(bool_or(status = 'FAILED' AND available), false) AS f, COUNT(*) FILTER (available) AS n, COUNT(*) FILTER (available AND status = 'SKIPPED') AS s, COUNT(*) FILTER (available AND status IN ('COMPLETED', 'ESTIMATED')) AS c, COUNT(*) AS a FROM r GROUP BY 1)
    SELECT stage, CASE WHEN f THEN 'FAILED' WHEN n > 0 AND s = n THEN 'SKIPPED' WHEN n > 0 AND c = n AND n = a THEN 'COMPLETED' WHEN n > 0 THEN 'OUTPUT_AVAILABLE' ELSE 'UNRUN' END AS state FROM g""",
)
def _(t):
    return cohort.status_snapshot(t.spark.sql(f"SELECT {STAGE_ROWS} FROM {{orders}}", orders=t.table("orders")))


@query(
    "agg_53_carrier_by_group",
    """+ s AS (SELECT person_id, CASE WHEN discovery_donor = 'no' AND related_to_discovery_donor = 'no' THEN CASE WHEN analysis_eligible = 'yes' AND unrelated_primary = 'yes' THEN 'independent_primary' ELSE 'non_donor_not_primary' END
      WHEN 'yes' IN (discovery_donor, related_to_discovery_donor) THEN 'discovery_overlap' ELSE 'independence_unknown' END AS independence_group FROM donors)
    SELECT allele_id, independence_group, COUNT(*) AS attempted, COUNT(*) FILTER (callable = 'yes') AS callable, COUNT(*) FILTER (callable = 'yes' AND carrier_status = 'ALT_SUPPORTED') AS carriers, COUNT(*) FILTER (callable <> 'yes') AS no_call FROM cells JOIN s USING (person_id) GROUP BY 1, 2""",
    ("cells", "donors"),
)
def _(t):
    return cohort.carrier_by_group(t.cells, t.donors)


# walks, locks and placements


def links_both(t: Tables) -> DataFrame:
    return t.links.selectExpr("IF(left_forward, '>', '<') || left_id AS left_token", "'>' || right_id AS right_token")


BASES = "substr('ACGTTGCAAC', CAST(1 + n % 7 AS INT), CAST(1 + n % 4 AS INT))"
WALK = "SELECT n, CASE WHEN n % 3 = 0 THEN '<s' || (n + 1) || CASE WHEN n % 2 = 0 THEN '<' ELSE '>' END || 's' || n ELSE CASE WHEN n % 2 = 0 THEN '>' ELSE '<' END || 's' || n || '>s' || (n + 1) || CASE WHEN n % 5 = 1 THEN '>s' || (n + 7) ELSE '' END END AS path"


@query(
    "gr_6_verify_walks",
    f"""+ sq AS (SELECT segment_id, {BASES} AS seq FROM segments), wk AS ({WALK} FROM segments), tk AS (SELECT *, regexp_extract_all(path, '[><][^><]+') AS k FROM wk), st AS (SELECT n, unnest(k) AS token, unnest(list_concat(k[2:], [NULL])) AS nxt, generate_subscripts(k, 1) AS step FROM tk),
    lk AS (SELECT DISTINCT CASE WHEN left_forward THEN '>' ELSE '<' END || left_id AS a, '>' || right_id AS b FROM links), ab AS (SELECT a, b FROM lk UNION SELECT translate(substr(b, 1, 1), '><', '<>') || substr(b, 2), translate(substr(a, 1, 1), '><', '<>') || substr(a, 2) FROM lk)
    SELECT 'w' || n AS walk_id, COUNT(*) FILTER (nxt IS NOT NULL AND a IS NULL) AS missing_links, COUNT(*) FILTER (seq IS NULL) AS unknown_segments, CAST(SUM(length(seq)) AS BIGINT) AS length,
      sha256(coalesce(string_agg(CASE WHEN token[1] = '<' THEN {RC.format("seq")} ELSE seq END, '' ORDER BY step), '')) AS sequence_sha256 FROM st LEFT JOIN ab ON a = token AND b = nxt LEFT JOIN sq ON segment_id = substr(token, 2) GROUP BY n""",
    ("segments", "links"),
)
def _(t):
    walks = t.spark.sql(WALK + " FROM {segments}", segments=t.segments).selectExpr("'w' || n AS walk_id", "path")
    return graph.verify_walks(walks, t.segments.selectExpr("segment_id", f"{BASES} AS seq"), links_both(t))


PILOT = "event_id, event_id % 5 AS \"left\", event_id % 4 AS \"right\", event_id % 3 AS reference, CASE event_id % 7 WHEN 0 THEN 'blinded' WHEN 1 THEN 'unknown' WHEN 2 THEN 'insertion_absent' ELSE 'insertion_present' END AS expected"


@query(
    "flt_23_pilot_call",
    f"""WITH p AS (SELECT {PILOT} FROM events), c AS (SELECT *, CASE WHEN "left" >= 2 AND "right" >= 2 THEN CASE WHEN reference >= 2 THEN 'ALT_and_reference_supported' ELSE 'ALT_supported' END WHEN reference >= 2 AND "left" + "right" = 0 THEN 'reference_supported' ELSE 'no_call' END AS pilot_call FROM p)
    SELECT event_id, pilot_call, ROUND(("left" + "right") / CAST(nullif("left" + "right" + 2 * reference, 0) AS DOUBLE), 6) AS allele_balance, CASE WHEN expected = 'blinded' THEN 'blinded' WHEN pilot_call = 'no_call' THEN 'no_call' WHEN expected = 'unknown' THEN 'unknown_expectation'
      WHEN (expected = 'insertion_present') = (pilot_call[1:3] = 'ALT') THEN 'concordant' ELSE 'discordant' END AS concordance FROM c""",
)
def _(t):
    rows = t.spark.sql(f"SELECT {PILOT.replace(chr(34), chr(96))} FROM {{events}}", events=t.table("events"))
    return evidence.pilot_call(rows).select("event_id", "pilot_call", "allele_balance", "concordance")


@query(
    "flt_17_measurement_lock",
    """+ e AS (SELECT person_id, allele_id, o % 6 AS l, o % 4 AS r, o % 5 AS f, CASE WHEN o % 8 <> 0 THEN o % 30 END AS d, CAST(o % 10 AS DOUBLE) / 10 AS m FROM cells), k AS (SELECT DISTINCT 'A' || (o_orderkey % 20) AS allele_id, o_orderkey % 20 <> 7 AS pass FROM orders)
    SELECT person_id, allele_id, CASE WHEN NOT coalesce(pass, false) THEN 'NOT_LOCKED' WHEN d IS NULL OR m > 0.5 OR d < 5 THEN 'NO_CALL' WHEN l >= 2 AND r >= 2 THEN 'ALT_SUPPORTED' WHEN l = 0 AND r = 0 AND f >= 2 THEN 'REF_SUPPORTED' ELSE 'NO_CALL' END AS carrier_state FROM e LEFT JOIN k USING (allele_id)""",
    ("cells",),
)
def _(t):
    rows = t.cells.selectExpr("person_id", "'l' AS locus_id", "'g' AS graph_id", "allele_id", "o % 6 AS left_support", "o % 4 AS right_support", "o % 5 AS reference_support", "CASE WHEN o % 8 <> 0 THEN o % 30 END AS depth", "CAST(o % 10 AS DOUBLE) / 10 AS mapping_ambiguity")
    locks = t.table("orders").selectExpr("'l' AS locus_id", "'g' AS graph_id", "'A' || (o_orderkey % 20) AS allele_id", "IF(o_orderkey % 20 = 7, 'FAIL', 'PASS') AS technical_status", "2 AS min_alt", "2 AS min_ref", "5 AS min_depth", "0.5D AS max_mapping_ambiguity").distinct()
    return evidence.apply_measurement_lock(rows, locks).select("person_id", "allele_id", "carrier_state")


@query(
    "jn_38_placement_hits",
    """+ q AS (SELECT feature_id AS query_name, gene_id, CASE n % 4 WHEN 0 THEN 'REF' WHEN 1 THEN 'ALT' WHEN 2 THEN 'LEFT' ELSE 'RIGHT' END AS query_type, 2200 + CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END AS query_length FROM features WHERE n % 6 <> 5)
    SELECT gene_id AS allele_id, chromosome AS resource, query_type, COUNT(*) AS hits FROM placements JOIN q ON query_name = query_id WHERE qlen = query_length GROUP BY 1, 2, 3""",
    ("features", "placements"),
)
def _(t):
    queries = t.features.filter("n % 6 <> 5").selectExpr("feature_id AS query_name", "gene_id AS allele_id", "feature_id AS locus_id", "CASE n % 4 WHEN 0 THEN 'REF' WHEN 1 THEN 'ALT' WHEN 2 THEN 'LEFT' ELSE 'RIGHT' END AS query_type", "2200 + IF(n % 10 = 0, 1, 0) AS query_length")
    resources = t.features.select(F.col("chromosome").alias("resource"), F.lit("1").alias("resource_version")).distinct()
    aln = t.placements.withColumnsRenamed({"query_id": "query_name", "chromosome": "resource"})
    return annotate.placement_hits(annotate.placement_evidence(aln, queries, resources))


@query("set_2_graph_members", "SELECT graph_id, sample_id FROM (SELECT 'g' || o_custkey % 3 AS graph_id, 'S' || o_custkey AS sample_id FROM orders UNION SELECT 'g' || c_custkey % 2, 'S' || c_custkey FROM customer)")
def _(t):
    used = t.table("orders").selectExpr("'g' || o_custkey % 3 AS graph_id", "'S' || o_custkey AS sample_id")
    return checks.graph_members(used, t.table("customer").selectExpr("'g' || c_custkey % 2 AS graph_id", "'S' || c_custkey AS sample_id"))


@query(
    "set_4_outer_fill",
    "+ a AS (SELECT sn AS chromosome, COUNT(*) AS segments FROM segments GROUP BY 1), b AS (SELECT chromosome, COUNT(*) AS features FROM features WHERE chromosome <> 'chr2' GROUP BY 1) SELECT coalesce(a.chromosome, b.chromosome) AS chromosome, coalesce(segments, 0) AS segments, coalesce(features, 0) AS features FROM a FULL JOIN b ON a.chromosome = b.chromosome",
    ("segments", "features"),
)
def _(t):
    segments = t.segments.groupBy(F.col("sn").alias("chromosome")).agg(F.count(F.lit(1)).alias("segments"))
    return checks.outer_fill(segments, t.features.filter("chromosome <> 'chr2'").groupBy("chromosome").agg(F.count(F.lit(1)).alias("features")), ["chromosome"])


@query(
    "jn_19_assign_molecules",
    "+ f AS (SELECT DISTINCT sample_id, string_split(read_name, '/')[1] AS fragment FROM gaf), m AS (SELECT sample_id, string_split(read_name, '/')[1] AS fragment, MIN('m' || (event_id // 3)) AS molecule_id, COUNT(DISTINCT event_id // 3) AS n FROM gaf WHERE event_id % 5 <> 0 GROUP BY 1, 2) SELECT f.sample_id AS library_id, f.fragment, molecule_id, CASE WHEN n IS NULL THEN 'UNASSIGNED' WHEN n > 1 THEN 'CONFLICT' ELSE 'ASSIGNED' END AS molecule_status FROM f LEFT JOIN m USING (sample_id, fragment)",
    ("gaf",),
)
def _(t):
    named = t.gaf.select(F.col("sample_id").alias("library_id"), C.fragment_name(F.col("read_name")).alias("fragment"), "event_id")
    return evidence.assign_molecules(named.select("library_id", "fragment").distinct(), named.filter("event_id % 5 <> 0").selectExpr("library_id", "fragment", "'m' || (event_id div 3) AS molecule_id"))
