"""Queries on variant evidence, the catalogue, sequence graphs and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import annotate, catalog, checks, compare, graph, intervals
from ..operators.components import components, saved
from .registry import Tables, query

# The greedy clustering as a recursive walk: inside a gap-cut block, rows are numbered and each either opens a cluster or joins the
# newest open one that fits. State: open heads as a list of structs.
ORDERED = """o AS (SELECT *, CASE WHEN position_0 - LAG(position_0) OVER w <= 500 THEN 0 ELSE 1 END AS fresh FROM evidence WINDOW w AS (PARTITION BY frame, chromosome ORDER BY position_0, svtype, svlen, evidence_id)),
    b AS (SELECT *, SUM(fresh) OVER (PARTITION BY frame, chromosome ORDER BY position_0, svtype, svlen, evidence_id ROWS UNBOUNDED PRECEDING) AS block FROM o),
    n AS (SELECT frame, chromosome, block, position_0, svtype, svlen, evidence_id, ROW_NUMBER() OVER (PARTITION BY frame, chromosome, block ORDER BY position_0, svtype, svlen, evidence_id) AS r FROM b),
    walk AS (
      SELECT frame, chromosome, block, r, evidence_id, evidence_id AS head, [{'p': position_0, 't': svtype, 'l': svlen, 'id': evidence_id}] AS heads FROM n WHERE r = 1
      UNION ALL
      SELECT n.frame, n.chromosome, n.block, n.r, n.evidence_id, COALESCE(m.fit[1].id, n.evidence_id),
        CASE WHEN len(m.fit) > 0 THEN w.heads ELSE list_concat([{'p': n.position_0, 't': n.svtype, 'l': n.svlen, 'id': n.evidence_id}], w.heads) END
      FROM walk w JOIN n ON n.frame = w.frame AND n.chromosome = w.chromosome AND n.block = w.block AND n.r = w.r + 1,
        LATERAL (SELECT list_filter(w.heads, lambda h: n.position_0 - h.p <= 500 AND h.t = n.svtype AND (h.l = 0 OR n.svlen = 0 OR least(h.l, n.svlen) / CAST(greatest(h.l, n.svlen) AS DOUBLE) >= 0.7)) AS fit) m),
    cl AS (SELECT e.*, w.head AS cluster_head FROM evidence e JOIN walk w ON w.evidence_id = e.evidence_id)"""


#: What places evidence in its cluster.
PLACED = ("frame", "chromosome", "position_0", "svtype", "svlen", "evidence_id")


def clustered(t: Tables) -> DataFrame:
    return catalog.cluster_evidence(t.evidence)


@query("win_3_greedy_clusters", f"+ {ORDERED} SELECT evidence_id, cluster_head FROM cl", ("evidence",))
def _(t):
    return catalog.cluster_evidence(t.evidence.select(*PLACED)).select("evidence_id", "cluster_head")


ROWS = (
    ORDERED
    + """, g AS (SELECT frame, chromosome, cluster_head, MIN({'p': position_0, 't': svtype, 'l': svlen, 'i': evidence_id}) AS first,
      arg_min({'p': position_0, 't': svtype, 'l': svlen}, CASE WHEN discovery_method = 'graph_residual' AND NOT graph_member THEN {'w': confidence_tier NOT IN ('HIGH_CONFIDENCE', 'CALLER_PASS'), 'n': -svlen, 'i': evidence_id} END) AS rep,
      COALESCE(string_agg(DISTINCT CASE WHEN discovery_method = 'graph_residual' AND NOT graph_member THEN sample_id END, ';' ORDER BY CASE WHEN discovery_method = 'graph_residual' AND NOT graph_member THEN sample_id END), '') AS carrier_samples,
      COUNT(DISTINCT CASE WHEN discovery_method = 'graph_residual' AND NOT graph_member THEN assembly_id END) AS carrier_assembly_count, COUNT(DISTINCT CASE WHEN discovery_method = 'graph_residual' AND NOT graph_member THEN sample_id END) AS independent_sample_count,
      COUNT(DISTINCT CASE WHEN discovery_method = 'graph_residual' AND graph_member THEN assembly_id END) AS graph_member_control_count, COUNT(DISTINCT CASE WHEN discovery_method <> 'graph_residual' THEN sample_id END) AS linear_supporting_sample_count,
      string_agg(DISTINCT discovery_method, ';' ORDER BY discovery_method) AS discovery_methods,
      COUNT(*) FILTER (discovery_method = 'graph_residual' AND NOT graph_member) AS nf, COUNT(*) FILTER (discovery_method = 'graph_residual' AND graph_member) AS nc,
      COUNT(*) FILTER (discovery_method = 'graph_residual' AND NOT graph_member AND confidence_tier = 'HIGH_CONFIDENCE') AS hi, COUNT(*) FILTER (discovery_method <> 'graph_residual' AND confidence_tier = 'CALLER_PASS') AS ps,
      COUNT(*) FILTER (discovery_method = 'graph_residual' AND NOT graph_member AND qc_tier <> '') AS nt, COUNT(*) FILTER (discovery_method = 'graph_residual' AND NOT graph_member AND qc_tier = 'primary') AS np, COUNT(*) AS evidence_count
      FROM cl GROUP BY 1, 2, 3),
    k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY frame, chromosome, first) AS ordinal, nt > 0 AND np = 0 AS poor FROM g WHERE nf > 0),
    cat AS (SELECT 'PSV_' || substr(sha1_hex, 1, 16) AS event_id, * FROM (SELECT *, sha1(frame || '|' || chromosome || '|' || rep.p || '|' || rep.t || '|' || rep.l || '|' || ordinal) AS sha1_hex,
      CASE WHEN nc > 0 OR poor THEN 'UNCERTAIN' WHEN hi > 0 AND (ps > 0 OR independent_sample_count >= 2) THEN 'HIGH' WHEN hi > 0 THEN 'MEDIUM' ELSE 'UNCERTAIN' END AS confidence,
      CASE WHEN nc > 0 THEN 'GRAPH_MEMBER_CONTROL_OVERLAP' WHEN poor THEN 'PENDING_HIFI' WHEN ps > 0 THEN 'LINEAR_CALLER_SUPPORTED' ELSE 'ASSEMBLY_ONLY_REVIEW' END AS validation_status FROM k))"""
)


# The whole catalogue row over evidence with sequences: the walk also holds them, and lists are gathered as sets in order.
_FOUND, _CONTROL, _LINEAR = "discovery_method = 'graph_residual' AND NOT graph_member", "discovery_method = 'graph_residual' AND graph_member", "discovery_method <> 'graph_residual'"


def _list(name: str, value: str, where: str = "true") -> str:
    return f"COALESCE(string_agg(DISTINCT {value}, ';' ORDER BY {value}) FILTER ({where} AND {value} <> ''), '') AS {name}"


WHOLE = (
    ORDERED.replace("FROM evidence ", "FROM catalog_evidence ")
    .replace("svlen, evidence_id, ROW_NUMBER()", "svlen, evidence_id, alternate_sequence AS q, ROW_NUMBER()")
    .replace("'id': evidence_id}", "'id': evidence_id, 'q': q}")
    .replace("'id': n.evidence_id}", "'id': n.evidence_id, 'q': n.q}")
    .replace(">= 0.7))", ">= 0.7) AND (h.q = '' OR n.q = '' OR h.q = n.q))")
    + f""", g AS (SELECT frame, chromosome, cluster_head, MIN({{'p': position_0, 't': svtype, 'l': svlen, 'i': evidence_id}}) AS first,
      arg_min({{'p': position_0, 'e': end_0, 't': svtype, 'l': svlen, 'q': alternate_sequence, 's': graph_segment, 'o': segment_offset_0}}, {{'w': confidence_tier NOT IN ('HIGH_CONFIDENCE', 'CALLER_PASS'), 'n': -svlen, 'i': evidence_id}}) FILTER ({_FOUND}) AS rep,
      {_list("carrier_assemblies", "assembly_id", _FOUND)}, {_list("carrier_haplotypes", "(sample_id || ':' || haplotype)", _FOUND)}, {_list("carrier_samples", "sample_id", _FOUND)},
      {_list("graph_member_control_assemblies", "assembly_id", _CONTROL)}, {_list("linear_supporting_samples", "sample_id", _LINEAR)}, {_list("discovery_methods", "discovery_method")}, {_list("caller_support", "caller")},
      {_list("assembly_qc_tiers", "qc_tier", _FOUND)}, {_list("sex_chromosome_status", "sex_chromosome_status")}, {_list("evidence_ids", "evidence_id")},
      COUNT(DISTINCT assembly_id) FILTER ({_FOUND}) AS carrier_assembly_count, COUNT(DISTINCT sample_id) FILTER ({_FOUND}) AS independent_sample_count, COUNT(DISTINCT assembly_id) FILTER ({_CONTROL}) AS graph_member_control_count,
      COUNT(DISTINCT sample_id) FILTER ({_LINEAR}) AS linear_supporting_sample_count, COUNT(*) FILTER ({_FOUND}) AS nf, COUNT(*) FILTER ({_CONTROL}) AS nc, COUNT(*) FILTER ({_FOUND} AND confidence_tier = 'HIGH_CONFIDENCE') AS hi,
      COUNT(*) FILTER ({_LINEAR} AND confidence_tier = 'CALLER_PASS') AS ps, COUNT(*) FILTER ({_FOUND} AND qc_tier <> '') AS nt, COUNT(*) FILTER ({_FOUND} AND qc_tier = 'primary') AS np, COUNT(*) AS evidence_count
      FROM cl GROUP BY 1, 2, 3),
    k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY frame, chromosome, first) AS ordinal, nt > 0 AND np = 0 AS poor FROM g WHERE nf > 0),
    whole AS (SELECT 'PSV_' || substr(sha1(frame || '|' || chromosome || '|' || rep.p || '|' || rep.t || '|' || rep.l || '|' || ordinal), 1, 16) AS event_id, ordinal, frame AS coordinate_system, chromosome, sex_chromosome_status, rep.p AS position_0, rep.e AS end_0, rep.t AS svtype, rep.l AS svlen,
      '' AS reference_allele, rep.q AS alternate_allele, rep.s AS graph_segment, rep.o AS segment_offset_0, carrier_assemblies, carrier_haplotypes, carrier_samples, carrier_assembly_count, independent_sample_count, graph_member_control_assemblies, graph_member_control_count,
      linear_supporting_samples, linear_supporting_sample_count, discovery_methods, caller_support, assembly_qc_tiers, 'RESIDUAL_TO_FROZEN_GRAPH' AS graph_representation_status,
      CASE WHEN nc > 0 THEN 'GRAPH_MEMBER_CONTROL_OVERLAP' WHEN poor THEN 'PENDING_HIFI' WHEN ps > 0 THEN 'LINEAR_CALLER_SUPPORTED' ELSE 'ASSEMBLY_ONLY_REVIEW' END AS validation_status,
      CASE WHEN nc > 0 OR poor THEN 'UNCERTAIN' WHEN hi > 0 AND (ps > 0 OR independent_sample_count >= 2) THEN 'HIGH' WHEN hi > 0 THEN 'MEDIUM' ELSE 'UNCERTAIN' END AS confidence, evidence_ids, evidence_count FROM k)"""
)


def whole_catalog(t: Tables) -> DataFrame:
    return catalog.catalog_rows(catalog.cluster_evidence(t.catalog_evidence)).drop("frame")


@query("agg_24_catalog_rows", f"+ {WHOLE} SELECT * FROM whole", ("catalog_evidence",))
def _(t):
    return whole_catalog(t)


@query(
    "gr_7_chained_catalog",
    f"""+ {WHOLE}, d AS (SELECT *, coordinate_system = 'GRAPH' AS g, CASE WHEN svtype = 'INS' AND regexp_full_match(alternate_allele, '[ACGTN]+') THEN alternate_allele ELSE '' END AS ins FROM whole)
    SELECT event_id AS stable_event_id, CASE WHEN g THEN '' ELSE chromosome END AS chm13_chrom, CASE WHEN g THEN '' ELSE CAST(position_0 AS STRING) END AS chm13_start_0, CASE WHEN g THEN '' ELSE CAST(end_0 AS STRING) END AS chm13_end_0, graph_segment AS graph_node, COALESCE(CAST(segment_offset_0 AS STRING), '') AS graph_offset_0,
      svtype, CAST(svlen AS STRING) AS svlen, ins AS inserted_sequence, carrier_samples AS source_sample, discovery_methods AS discovery_method, confidence AS breakpoint_confidence, CASE WHEN ins <> '' THEN 'sequence_resolved' ELSE 'sequence_unavailable_or_not_insertion' END AS sequence_confidence,
      graph_representation_status AS graph_membership_status, CASE WHEN g THEN 'unprojected_preserved' ELSE 'projected' END AS projection_status, event_id AS source_event_id FROM d""",
    ("catalog_evidence",),
)
def _(t):
    """Evidence clustered, catalogued and normalised in one chain: what the catalogue writes is what the next step reads."""
    rows = whole_catalog(t).withColumnRenamed("ordinal", "row").withColumn("coordinate_system", F.when(F.col("coordinate_system") == "REF", "CHM13").otherwise(F.col("coordinate_system")))
    got = catalog.normalize_catalog([("provisional", rows, {})])
    return got.drop("grch38_chrom", "grch38_start_0", "grch38_end_0", "inserted_sequence_sha256", "source_graph")


@query("win_4_catalog_ordinals", f"+ {ROWS} SELECT frame, chromosome, MIN(ordinal) AS first_ordinal, MAX(ordinal) AS last_ordinal, COUNT(*) AS events FROM cat GROUP BY 1, 2", ("evidence",))
def _(t):
    return catalog.catalog_rows(clustered(t)).groupBy("frame", "chromosome").agg(F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"), F.count(F.lit(1)).alias("events"))


@query(
    "agg_26_sample_candidates",
    f"""+ {ROWS}, x AS (SELECT event_id, confidence, validation_status, rep.t AS svtype, unnest(string_split(carrier_samples, ';')) AS sample_id FROM cat),
    c AS (SELECT sample_id, string_agg(v, ';' ORDER BY v) AS by_confidence FROM (SELECT sample_id, confidence || '=' || COUNT(*) AS v FROM x GROUP BY sample_id, confidence) GROUP BY 1),
    s AS (SELECT sample_id, string_agg(v, ';' ORDER BY v) AS by_svtype FROM (SELECT sample_id, svtype || '=' || COUNT(*) AS v FROM x GROUP BY sample_id, svtype) GROUP BY 1),
    tp AS (SELECT sample_id, string_agg(event_id, ';' ORDER BY r) AS top_events FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY validation_status <> 'PENDING_HIFI', confidence <> 'HIGH', event_id) AS r FROM x) WHERE r <= 25 GROUP BY 1),
    a AS (SELECT sample_id, COUNT(*) AS candidates, COUNT(*) FILTER (confidence = 'HIGH') AS high FROM x GROUP BY 1)
    SELECT * FROM a JOIN c USING (sample_id) JOIN s USING (sample_id) JOIN tp USING (sample_id)""",
    ("evidence",),
)
def _(t):
    return catalog.sample_candidates(catalog.catalog_rows(clustered(t)))


@query(
    "top_3_select_events",
    f"""+ {ROWS}, cut AS (SELECT * FROM cat WHERE discovery_methods LIKE '%assembly_caller%' AND discovery_methods LIKE '%graph_residual%' ORDER BY independent_sample_count DESC, linear_supporting_sample_count DESC, rep.l DESC, event_id DESC LIMIT 100)
    SELECT event_id, ROW_NUMBER() OVER (ORDER BY independent_sample_count DESC, linear_supporting_sample_count DESC, rep.l DESC, event_id) AS selection_rank FROM cut""",
    ("evidence",),
)
def _(t):
    return catalog.select_events(catalog.catalog_rows(clustered(t)), 100, ["assembly_caller", "graph_residual"]).select("event_id", "selection_rank")


@query("flt_10_required_methods", f"+ {ROWS} SELECT confidence, COUNT(*) AS events FROM cat WHERE discovery_methods = 'assembly_caller;graph_residual' GROUP BY 1", ("evidence",))
def _(t):
    return catalog.catalog_rows(clustered(t)).filter(C.has_all(F.col("discovery_methods"), ["graph_residual", "assembly_caller"])).groupBy("confidence").agg(F.count(F.lit(1)).alias("events"))


@query("jn_17_account_evidence", f"+ {ROWS} SELECT CASE WHEN k.event_id IS NULL THEN 'UNMAPPED' ELSE 'COVERED' END AS account, COUNT(*) AS rows FROM cl LEFT JOIN cat k USING (frame, chromosome, cluster_head) GROUP BY 1", ("evidence",))
def _(t):
    c = saved(catalog.cluster_evidence(t.evidence.select(*PLACED, "discovery_method", "graph_member")).drop("frame", "chromosome", "position_0", "svtype", "svlen"))
    listed = c.groupBy("cluster_head").agg(F.collect_list("evidence_id").alias("evidence_ids"), F.bool_or((F.col("discovery_method") == "graph_residual") & ~F.col("graph_member")).alias("k")).filter("k")
    return catalog.account_evidence(listed.withColumnRenamed("cluster_head", "event_id"), c).groupBy("account").agg(F.count(F.lit(1)).alias("rows"))


@query("agg_25_sample_tiers", "SELECT sample_id, COALESCE(string_agg(DISTINCT CASE WHEN qc_tier <> '' THEN qc_tier END, ';' ORDER BY CASE WHEN qc_tier <> '' THEN qc_tier END), '') AS tiers, bool_or(graph_member) AS any_member FROM evidence GROUP BY 1", ("evidence",))
def _(t):
    return catalog.sample_tier(t.evidence)


PAIR = "a.frame = b.frame AND a.chromosome = b.chromosome AND a.svtype = b.svtype AND abs(a.position_0 - b.position_0) <= 500 AND (a.svlen = 0 OR b.svlen = 0 OR least(a.svlen, b.svlen) / CAST(greatest(a.svlen, b.svlen) AS DOUBLE) >= 0.7)"


def other(df: DataFrame) -> DataFrame:
    return df.select("frame", "chromosome", "svtype", *(F.col(c).alias(f"other_{c}") for c in ("position_0", "svlen", "evidence_id")))


@query("jn_9_breakpoint_band_join", f"SELECT a.evidence_id, b.evidence_id AS other_evidence_id FROM evidence a JOIN evidence b ON {PAIR} WHERE a.discovery_method = 'graph_residual' AND b.discovery_method <> 'graph_residual'", ("evidence",))
def _(t):
    graph_rows = t.evidence.filter("discovery_method = 'graph_residual'")
    return intervals.sv_match(graph_rows, other(t.evidence.filter("discovery_method <> 'graph_residual'"))).select("evidence_id", "other_evidence_id")


@query(
    "jn_10_best_source",
    f"""+ p AS (SELECT a.evidence_id AS event_id, b.evidence_id AS other_evidence_id, ROW_NUMBER() OVER (PARTITION BY a.evidence_id ORDER BY b.confidence_tier <> 'HIGH_CONFIDENCE', abs(a.position_0 - b.position_0), abs(a.svlen - b.svlen), b.evidence_id) AS r, COUNT(*) OVER (PARTITION BY a.evidence_id) AS sources
      FROM evidence a JOIN evidence b ON {PAIR} WHERE a.discovery_method <> 'graph_residual' AND b.discovery_method = 'graph_residual') SELECT event_id, sources, other_evidence_id FROM p WHERE r = 1""",
    ("evidence",),
)
def _(t):
    events = t.evidence.filter("discovery_method <> 'graph_residual'").withColumnRenamed("evidence_id", "event_id")
    return catalog.choose_sources(events.drop("confidence_tier"), t.evidence.filter("discovery_method = 'graph_residual'")).select("event_id", "sources", "other_evidence_id")


@query("flt_8_exclude_contigs", "SELECT caller, COUNT(*) AS rows FROM evidence WHERE CASE WHEN caller = 'caller1' THEN chromosome NOT IN ('chr1', 'chr2') ELSE chromosome <> 'chr5' END GROUP BY 1", ("evidence",))
def _(t):
    return catalog.exclude_contigs(t.evidence, "chr5", {"caller1": "chr[12]"}).groupBy("caller").agg(F.count(F.lit(1)).alias("rows"))


@query("flt_9_size_filter", "SELECT svtype, COUNT(*) AS rows FROM evidence WHERE svlen >= 400 OR svtype IN ('BND', 'TRA', 'CTX', 'INV') GROUP BY 1", ("evidence",))
def _(t):
    return catalog.filter_sv_size(t.evidence, 400).groupBy("svtype").agg(F.count(F.lit(1)).alias("rows"))


@query("flt_11_coordinate_gate", "+ e AS (SELECT svlen, CASE WHEN position_0 % 97 <> 0 THEN position_0 END AS p FROM evidence WHERE svlen >= 50) SELECT COUNT(*) AS events, COUNT(p) AS resolved, ROUND(1 - COUNT(p) / CAST(COUNT(*) AS DOUBLE), 6) AS unresolved_fraction, CASE WHEN 1 - COUNT(p) / CAST(COUNT(*) AS DOUBLE) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status FROM e", ("evidence",))
def _(t):
    return catalog.coordinate_qc(t.evidence.withColumn("position_0", F.when(F.col("position_0") % 97 != 0, F.col("position_0"))))


@query("scl_13_stable_ids", "SELECT evidence_id, 'EVD_' || substr(sha1(frame || '|' || chromosome || '|' || position_0 || '|' || svtype), 1, 16) AS stable_id, 'SV_' || substr(sha256(chromosome || chr(1) || svlen), 1, 16) AS sequence_id FROM evidence", ("evidence",))
def _(t):
    cols = [F.col(c) for c in ("frame", "chromosome", "position_0", "svtype")]
    return t.evidence.select("evidence_id", C.stable_id("EVD_", "sha1", 16, "|", *cols).alias("stable_id"), C.stable_id("SV_", "sha256", 16, "\x01", F.col("chromosome"), F.col("svlen")).alias("sequence_id"))


@query("scl_23_size_bins", "SELECT CASE WHEN svlen < 50 THEN 'complex under 50' WHEN svlen < 100 THEN '50-99' WHEN svlen < 1000 THEN '100-999' WHEN svlen < 10000 THEN '1-9kb' ELSE '>=10kb' END AS size_bin, COUNT(*) AS rows FROM evidence GROUP BY 1", ("evidence",))
def _(t):
    return t.evidence.groupBy(C.size_bin(F.col("svlen"), "fine").alias("size_bin")).agg(F.count(F.lit(1)).alias("rows"))


@query("scl_26_sex_chromosomes", "SELECT evidence_id, CASE WHEN frame = 'GRAPH' THEN 'NOT_ASSESSED' WHEN chromosome = 'chr5' THEN 'SEX_CHROMOSOME' ELSE 'AUTOSOME' END AS status FROM evidence", ("evidence",))
def _(t):
    chrom = F.when(F.col("chromosome") == "chr5", "chrX").otherwise(F.col("chromosome"))
    return t.evidence.select("evidence_id", C.sex_chromosome_status(F.col("frame"), chrom).alias("status"))


@query("agg_36_descriptive_counts", "SELECT svtype, confidence_tier, qc_tier, COUNT(*) AS n FROM evidence GROUP BY 1, 2, 3", ("evidence",))
def _(t):
    from ..operators.cohort import descriptive_counts

    return descriptive_counts(t.evidence, ["svtype", "confidence_tier", "qc_tier"])


@query(
    "set_3_multiset_delta",
    """+ o AS (SELECT chromosome, svtype, svlen, COUNT(*) AS n FROM evidence WHERE discovery_method = 'graph_residual' GROUP BY 1, 2, 3), w AS (SELECT chromosome, svtype, svlen, COUNT(*) AS n FROM evidence WHERE discovery_method <> 'graph_residual' GROUP BY 1, 2, 3)
    SELECT 'NEW' AS change, CAST(SUM(greatest(COALESCE(w.n, 0) - COALESCE(o.n, 0), 0)) AS BIGINT) AS records FROM w FULL JOIN o USING (chromosome, svtype, svlen) UNION ALL SELECT 'MISSING', CAST(SUM(greatest(COALESCE(o.n, 0) - COALESCE(w.n, 0), 0)) AS BIGINT) FROM w FULL JOIN o USING (chromosome, svtype, svlen)""",
    ("evidence",),
)
def _(t):
    key = ["chromosome", "svtype", "svlen"]
    old, new = (t.evidence.filter(f"discovery_method {op} 'graph_residual'").select(*key) for op in ("=", "<>"))
    return catalog.multiset_delta(old, new, key).groupBy("change").agg(F.count(F.lit(1)).alias("records"))


@query("set_1_compare_sets", "+ a AS (SELECT DISTINCT assembly_id FROM evidence WHERE caller = 'caller0'), b AS (SELECT DISTINCT assembly_id FROM evidence WHERE graph_member) SELECT assembly_id, 'left_only' AS side FROM a WHERE assembly_id NOT IN (SELECT assembly_id FROM b) UNION ALL SELECT assembly_id, 'right_only' FROM b WHERE assembly_id NOT IN (SELECT assembly_id FROM a)", ("evidence",))
def _(t):
    return checks.compare_sets(t.evidence.filter("caller = 'caller0'"), t.evidence.filter("graph_member"), "assembly_id")


@query(
    "gr_3_transitive_clusters",
    """+ r AS (SELECT evidence_id, chromosome, svtype, position_0 AS p, svlen AS l, alternate_sequence AS q, position_0 // 500 AS bin FROM catalog_evidence),
    w AS (SELECT *, unnest([bin - 1, bin, bin + 1]) AS near_bin FROM r),
    link AS (SELECT a.evidence_id AS a, b.evidence_id AS b FROM r a JOIN w b ON a.chromosome = b.chromosome AND a.svtype = b.svtype AND a.bin = b.near_bin AND abs(a.p - b.p) <= 500
      AND CASE WHEN greatest(a.l, b.l) = 0 THEN 1 ELSE least(a.l, b.l) / CAST(greatest(a.l, b.l) AS DOUBLE) END >= 0.7 AND (a.q = '' OR b.q = '' OR a.q = b.q)),
    reach AS (SELECT evidence_id AS a, evidence_id AS b FROM r UNION SELECT x.a, k.b FROM reach x JOIN link k ON k.a = x.b)
    SELECT x.a AS event_id, 'SVC_' || substr(sha256(arg_max(x.b, {'p': r.p, 'i': x.b})), 1, 12) AS cluster_id FROM reach x JOIN r ON r.evidence_id = x.b GROUP BY x.a""",
    ("catalog_evidence",),
)
def _(t):
    return catalog.cluster_transitive(t.catalog_evidence.withColumnRenamed("evidence_id", "event_id"))


@query(
    "flt_22_rescue_plan",
    """+ r AS (SELECT evidence_id, CASE WHEN svlen % 11 <> 0 THEN assembly_id END AS source, CASE WHEN svlen % 13 <> 0 THEN 'p' END AS path, svlen % 3 = 0 AS ready, position_0 AS q, svlen, greatest(position_0 - 50000, 0) AS s, least(position_0 + svlen + 50000, 2000000) AS e FROM evidence)
    SELECT evidence_id, s AS seed_start, e AS seed_end, CASE WHEN source IS NULL THEN 'NO_MATCHING_SOURCE' WHEN path IS NULL THEN 'MISSING_ASSEMBLY_PATH' WHEN NOT ready THEN 'WAITING_FOR_HIFI' WHEN least(q - s, e - q - svlen) < 20000 THEN 'SOURCE_NEAR_CONTIG_END' ELSE 'READY' END AS plan_status FROM r""",
    ("evidence",),
)
def _(t):
    rows = t.evidence.withColumns({"source_contig": F.when(F.col("svlen") % 11 != 0, F.col("assembly_id")), "path": F.when(F.col("svlen") % 13 != 0, "p"), "reads_ready": F.col("svlen") % 3 == 0, "query_position_0": F.col("position_0"), "contig_length": F.lit(2_000_000)})
    return catalog.plan_rescues(rows).select("evidence_id", "seed_start", "seed_end", "plan_status")


@query(
    "top_1_recommended_samples",
    """+ s AS (SELECT sample_id, 0.80 + CAST(COUNT(*) % 20 AS DOUBLE) / 100 AS min_callable, CAST(SUM(svlen) AS BIGINT) % 1000 AS uncallable, COUNT(*) FILTER (confidence_tier = 'HIGH_CONFIDENCE') % 7 AS candidates FROM evidence GROUP BY 1),
    bl AS (SELECT *, 'P1_BLIND_SPOT' AS tier FROM s WHERE min_callable < 0.85), re AS (SELECT * FROM s WHERE min_callable >= 0.85),
    va AS (SELECT sample_id, min_callable, uncallable, candidates, 'P2_VALIDATION' AS tier FROM re WHERE candidates > 0 ORDER BY candidates DESC, min_callable, sample_id LIMIT 10),
    co AS (SELECT sample_id, min_callable, uncallable, candidates, 'P3_CONTROL' AS tier FROM re WHERE sample_id NOT IN (SELECT sample_id FROM va) ORDER BY min_callable DESC, candidates, sample_id LIMIT 5), al AS (SELECT * FROM bl UNION ALL SELECT * FROM va UNION ALL SELECT * FROM co)
    SELECT sample_id, tier, ROW_NUMBER() OVER (ORDER BY tier, uncallable DESC, min_callable, candidates DESC, sample_id) AS request_rank FROM al""",
    ("evidence",),
)
def _(t):
    s = t.evidence.groupBy("sample_id").agg((F.lit(0.80) + (F.count(F.lit(1)) % 20).cast("double") / 100).alias("min_callable"), (F.sum("svlen") % 1000).alias("uncallable"), (F.count_if(F.col("confidence_tier") == "HIGH_CONFIDENCE") % 7).alias("candidates"))
    return catalog.recommend(s, 0.85, 10, 5).select("sample_id", "tier", "request_rank")


# graphs


@query("agg_16_rank_tally", "+ s AS (SELECT sr, COUNT(*) AS segments, CAST(SUM(ln) AS BIGINT) AS bp FROM segments GROUP BY 1), l AS (SELECT sr, COUNT(*) AS links FROM links GROUP BY 1) SELECT COALESCE(s.sr, l.sr) AS sr, COALESCE(segments, 0) AS segments, COALESCE(bp, 0) AS bp, COALESCE(links, 0) AS links FROM s FULL JOIN l ON s.sr = l.sr", ("segments", "links"))
def _(t):
    return graph.rank_tally(t.segments, t.links)


DEGREES = "e AS (SELECT left_id AS segment_id FROM links UNION ALL SELECT right_id FROM links), dg AS (SELECT s.*, (SELECT COUNT(*) FROM e WHERE e.segment_id = s.segment_id) AS degree FROM segments s)"


@query("agg_17_degrees", f"+ {DEGREES} SELECT segment_id, degree FROM dg", ("segments", "links"))
def _(t):
    return graph.degrees(t.segments, t.links).select("segment_id", "degree")


@query(
    "agg_18_graph_overview",
    f"""+ {DEGREES}, v AS (SELECT {{'segments': CAST(COUNT(*) AS DOUBLE), 'bp': CAST(SUM(ln) AS DOUBLE), 'reference_bp': CAST(SUM(CASE WHEN sr = 0 THEN ln ELSE 0 END) AS DOUBLE), 'nonreference_bp': CAST(SUM(CASE WHEN sr <> 0 THEN ln ELSE 0 END) AS DOUBLE), 'mean_length': AVG(ln), 'median_length': CAST(median(ln) AS DOUBLE),
      {", ".join(f"'length_q{q}': quantile_cont(CAST(ln AS DOUBLE), {q / 100})" for q in (0, 10, 25, 75, 90, 99, 100))}, 'mean_degree': AVG(degree), 'max_degree': CAST(MAX(degree) AS DOUBLE), 'hubs': CAST(COUNT(*) FILTER (degree >= 4) AS DOUBLE), 'lt_50': CAST(COUNT(*) FILTER (ln < 50) AS DOUBLE), '50_1000': CAST(COUNT(*) FILTER (ln >= 50 AND ln < 1000) AS DOUBLE),
      '1000_10000': CAST(COUNT(*) FILTER (ln >= 1000 AND ln < 10000) AS DOUBLE), 'gt_10kb': CAST(COUNT(*) FILTER (ln > 10000) AS DOUBLE), 'gt_100kb': CAST(COUNT(*) FILTER (ln > 100000) AS DOUBLE)}} AS x FROM dg),
    n5 AS (SELECT CAST(MAX(ln) AS DOUBLE) AS n50 FROM (SELECT ln, SUM(ln) OVER (ORDER BY ln DESC ROWS UNBOUNDED PRECEDING) AS r, SUM(ln) OVER () AS a FROM segments) WHERE 2 * r >= a),
    {"u AS (" + " UNION ALL ".join(f"SELECT '{m}' AS metric, x.\"{m}\" AS value FROM v" for m in ("segments", "bp", "reference_bp", "nonreference_bp", "mean_length", "median_length", *(f"length_q{q}" for q in (0, 10, 25, 75, 90, 99, 100)), "mean_degree", "max_degree", "hubs", "lt_50", "50_1000", "1000_10000", "gt_10kb", "gt_100kb")) + " UNION ALL SELECT 'n50', n50 FROM n5)"}
    SELECT metric, ROUND(value, 6) AS value FROM u""",
    ("segments", "links"),
)
def _(t):
    return graph.graph_overview(t.segments, graph.degrees(t.segments, t.links))


@query("agg_19_rank_conflicts", "SELECT sn, COUNT(DISTINCT sr) AS ranks, COUNT(*) AS segments, CAST(SUM(ln) AS BIGINT) AS bp FROM segments GROUP BY 1 HAVING COUNT(DISTINCT sr) > 1", ("segments",))
def _(t):
    return graph.rank_conflicts(t.segments)


# components of the adapter stay inside blocks of 25 ids, so a recursive reach is affordable
REACH = """ed AS (SELECT left_id AS a, right_id AS b FROM links UNION SELECT right_id, left_id FROM links),
    rc AS (SELECT a AS node, a AS r FROM ed UNION SELECT ed.b, rc.r FROM rc JOIN ed ON ed.a = rc.node), cp AS (SELECT node, MIN(r) AS root FROM rc GROUP BY 1)"""


@query("gr_1_connected_components", f"+ {REACH} SELECT node, root FROM cp", ("links",))
def _(t):
    return components(t.links, "left_id", "right_id")


LABEL = f"""{REACH}, sg AS (SELECT s.*, COALESCE(c.root, s.segment_id) AS component FROM segments s LEFT JOIN cp c ON c.node = s.segment_id), bs AS (SELECT component, sn, SUM(ln) AS bp FROM sg WHERE sr = 0 GROUP BY 1, 2),
    lb AS (SELECT component, sn AS chromosome FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY component ORDER BY bp DESC, sn) AS r FROM bs) WHERE r = 1), la AS (SELECT sg.*, lb.chromosome FROM sg LEFT JOIN lb USING (component))"""


@query("gr_1_reference_chromosome", f"+ {LABEL} SELECT segment_id, component, chromosome FROM la", ("segments", "links"))
def _(t):
    return graph.assign_reference_chromosome(t.segments, t.links).select("segment_id", "component", "chromosome")


@query("agg_20_per_chromosome", f"+ {LABEL}, g AS (SELECT chromosome, CAST(SUM(CASE WHEN sr = 0 THEN ln ELSE 0 END) AS BIGINT) AS reference_bp, CAST(SUM(CASE WHEN sr <> 0 THEN ln ELSE 0 END) AS BIGINT) AS nonreference_bp FROM la GROUP BY 1) SELECT chromosome, reference_bp, nonreference_bp, ROUND(CASE WHEN reference_bp > 0 THEN 1000000.0 * nonreference_bp / CAST(reference_bp AS DOUBLE) END, 6) AS nonreference_per_mb FROM g", ("segments", "links"))
def _(t):
    return graph.per_chromosome(graph.assign_reference_chromosome(t.segments, t.links)).drop("chromosome_order")


@query(
    "gr_2_anchor_status",
    f"""+ {LABEL}, n AS (SELECT segment_id FROM segments WHERE sr = 3), x AS (SELECT n.segment_id, COUNT(DISTINCT la.chromosome) AS anchors FROM n LEFT JOIN ed ON ed.a = n.segment_id LEFT JOIN la ON la.segment_id = ed.b GROUP BY 1)
    SELECT segment_id, anchors, CASE anchors WHEN 0 THEN 'UNANCHORED' WHEN 1 THEN 'ANCHORED' ELSE 'CROSS_REFERENCE_COMPONENT' END AS status FROM x""",
    ("segments", "links"),
)
def _(t):
    return graph.anchor_status(graph.assign_reference_chromosome(t.segments, t.links), t.segments.filter("sr = 3"), t.links)


@query(
    "gr_4_integrity",
    """+ k AS (SELECT segment_id FROM segments WHERE n % 97 <> 0), o AS (SELECT 'duplicate_segments' AS "check", COUNT(*) - COUNT(DISTINCT segment_id) AS observed FROM segments WHERE n % 97 <> 0 UNION ALL SELECT 'missing_tags', COUNT(*) FILTER (sn IS NULL OR sr IS NULL) FROM segments UNION ALL SELECT 'empty_segments', COUNT(*) FILTER (ln <= 0) FROM segments
      UNION ALL SELECT 'dangling_ends', (SELECT COUNT(*) FROM links WHERE left_id NOT IN (SELECT segment_id FROM k)) + (SELECT COUNT(*) FROM links WHERE right_id NOT IN (SELECT segment_id FROM k)) UNION ALL SELECT 'self_loops', COUNT(*) FILTER (left_id = right_id) FROM links)
    SELECT "check", observed, CASE WHEN observed = 0 THEN 'PASS' WHEN "check" = 'self_loops' THEN 'WARN' ELSE 'FAIL' END AS status FROM o""",
    ("segments", "links"),
)
def _(t):
    return graph.integrity_checks(t.segments.filter("n % 97 <> 0"), t.links)


@query("win_1_growth_curve", "+ b AS (SELECT sr, CAST(SUM(ln) AS BIGINT) AS novel_bp FROM segments WHERE sr > 0 GROUP BY 1) SELECT sr, novel_bp, CAST(SUM(novel_bp) OVER (ORDER BY sr) AS BIGINT) AS cumulative_bp, CAST(SUM(CASE WHEN sr > 1 THEN novel_bp ELSE 0 END) OVER (ORDER BY sr) AS BIGINT) AS cumulative_without_first_bp FROM b", ("segments",))
def _(t):
    return graph.growth_curve(graph.rank_tally(t.segments, t.links))


@query("st_8_growth_fit", "+ b AS (SELECT n % 40 + 1 AS sr, SUM(ln) AS bp FROM segments GROUP BY 1), c AS (SELECT sr, bp AS novel_bp, SUM(bp) OVER (ORDER BY sr) AS cum, MAX(sr) OVER () AS m FROM b) SELECT COUNT(*) AS points, ROUND(regr_slope(ln(cum), ln(sr)), 6) AS exponent, ROUND(exp(regr_intercept(ln(cum), ln(sr))), 6) AS scale, ROUND(AVG(CASE WHEN sr > floor(0.9 * m) THEN novel_bp END), 6) AS last_decile_mean_bp FROM c", ("segments",))
def _(t):
    tally = t.segments.groupBy((F.col("n") % 40 + 1).alias("sr")).agg(F.sum("ln").alias("bp"))
    return graph.growth_fit(graph.growth_curve(tally))


@query("win_2_inversions", "+ d AS (SELECT sn, so - LAG(so) OVER (PARTITION BY sn ORDER BY n) AS s FROM segments) SELECT sn, COUNT(*) FILTER (s < 0) AS inversions, COUNT(*) AS rows FROM d GROUP BY 1", ("segments",))
def _(t):
    return graph.count_inversions(t.segments, ["sn"], "n", "so")


@query("win_12_dense_ids", "+ c AS (SELECT n // 100 AS chunk, segment_id AS node_id FROM segments) SELECT chunk, node_id, ROW_NUMBER() OVER (ORDER BY chunk, length(node_id), node_id) AS dense_id FROM c", ("segments",))
def _(t):
    return graph.dense_ids(t.segments.select(F.expr("n div 100").alias("chunk"), F.col("segment_id").alias("node_id")))


@query(
    "win_15_tiling",
    """+ g AS (SELECT sn AS name, n, ln, SUM(ln) OVER (PARTITION BY sn ORDER BY n) AS e FROM segments), h AS (SELECT name, e - ln + (CASE WHEN n % 50 = 0 THEN 1 ELSE 0 END) AS start, e AS end_ FROM g), le AS (SELECT name, MAX(e) AS length FROM g GROUP BY 1),
    q AS (SELECT name, start <> COALESCE(LAG(end_) OVER (PARTITION BY name ORDER BY start, end_), 0) AS gap, end_ FROM h)
    SELECT name, COUNT(*) FILTER (gap) AS breaks, COUNT(*) FILTER (gap) = 0 AS contiguous, MAX(end_) = MAX(le.length) AS complete FROM q JOIN le USING (name) GROUP BY 1""",
    ("segments",),
)
def _(t):
    from pyspark.sql import Window

    e = F.sum("ln").over(Window.partitionBy("sn").orderBy("n"))
    g = t.segments.select(F.col("sn").alias("name"), "n", "ln", e.alias("e"))
    tiles = g.select("name", (F.col("e") - F.col("ln") + F.when(F.col("n") % 50 == 0, 1).otherwise(0)).alias("start"), F.col("e").alias("end_"))
    return graph.check_tiling(tiles, g.groupBy("name").agg(F.max("e").alias("length")))


@query(
    "jn_12_locate_on_path",
    """+ l AS (SELECT n, ln, segment_id FROM segments), p AS (SELECT a.n, a.segment_id AS s1, b.segment_id AS s2, a.ln AS l1, b.ln AS l2, (a.n * 7919) % (a.ln + b.ln) AS pos FROM l a JOIN l b ON b.n = a.n + 1)
    SELECT CAST(n AS STRING) AS event_id, CASE WHEN pos < l1 THEN s1 ELSE s2 END AS segment, CAST(CASE WHEN pos < l1 THEN pos ELSE l2 - (pos - l1) - 1 END AS BIGINT) AS segment_offset FROM p""",
    ("segments",),
)
def _(t):
    a = t.segments.select("n", F.col("segment_id").alias("s1"), F.col("ln").alias("l1"))
    b = t.segments.select((F.col("n") - 1).alias("n"), F.col("segment_id").alias("s2"), F.col("ln").alias("l2"))
    events = a.join(b, "n").select(F.col("n").cast("string").alias("event_id"), F.concat(F.lit(">"), "s1", F.lit("<"), "s2").alias("path"), ((F.col("n") * 7919) % (F.col("l1") + F.col("l2"))).alias("position"))
    return graph.locate_on_path(events, t.segments).select("event_id", "segment", "segment_offset")


# A link is a bridge if its right end can't be reached from its left end without it.
BRIDGES = """phys AS (SELECT DISTINCT CASE WHEN a < b THEN a ELSE b END AS x, CASE WHEN a < b THEN b ELSE a END AS y FROM (SELECT {'id': left_id, 'e': CASE WHEN left_forward THEN 'right' ELSE 'left' END} AS a, {'id': right_id, 'e': CASE WHEN right_forward THEN 'left' ELSE 'right' END} AS b FROM backbone_links)),
    e AS (SELECT x.id AS left_id, x.e AS left_end, y.id AS right_id, y.e AS right_end, ROW_NUMBER() OVER (ORDER BY x, y) AS eid FROM phys),
    und AS (SELECT eid, left_id AS a, right_id AS b FROM e UNION ALL SELECT eid, right_id, left_id FROM e),
    reach AS (SELECT eid, left_id AS node FROM e UNION SELECT r.eid, u.b FROM reach r JOIN und u ON u.a = r.node AND u.eid <> r.eid),
    bridge AS (SELECT * FROM e WHERE left_id <> right_id AND NOT EXISTS (SELECT 1 FROM reach r WHERE r.eid = e.eid AND r.node = e.right_id))"""
CUTS = (
    BRIDGES
    + """, refs AS (SELECT reference, start, end_, segment_id, LEAD(segment_id) OVER (PARTITION BY reference ORDER BY start) AS next FROM backbone_nodes WHERE reference IS NOT NULL),
    cand AS (SELECT r.reference, r.end_ AS at, b.eid FROM refs r JOIN bridge b ON {'l': b.left_id, 'le': b.left_end, 'r': b.right_id, 're': b.right_end} IN ({'l': r.segment_id, 'le': 'right', 'r': r.next, 're': 'left'}, {'l': r.next, 'le': 'left', 'r': r.segment_id, 're': 'right'})),
    targets AS (SELECT reference, unnest(range(30000, len, 30000)) AS target FROM (SELECT reference, MAX(end_) AS len FROM refs GROUP BY 1)),
    bounds AS (SELECT t.reference, t.target, c.at AS nearest_safe, abs(c.at - t.target) AS distance, COALESCE(abs(c.at - t.target) <= 4000, false) AS selected, c.eid FROM targets t LEFT JOIN cand c ON c.reference = t.reference QUALIFY ROW_NUMBER() OVER (PARTITION BY t.reference, t.target ORDER BY abs(c.at - t.target), c.at) = 1),
    cut AS (SELECT DISTINCT eid FROM bounds WHERE selected)"""
)
CHUNKS = (
    CUTS
    + """, hold AS (SELECT segment_id AS node, segment_id AS other FROM backbone_nodes UNION SELECT h.node, u.b FROM hold h JOIN und u ON u.a = h.other WHERE u.eid NOT IN (SELECT eid FROM cut)),
    own AS (SELECT node AS segment_id, MIN(other) AS chunk FROM hold GROUP BY 1),
    per AS (SELECT chunk, reference, SUM(ln) AS bp, COUNT(*) AS n, MIN(start) AS s, MAX(end_) AS t FROM backbone_nodes JOIN own USING (segment_id) GROUP BY 1, 2),
    sums AS (SELECT chunk, COALESCE(string_agg(reference, ';' ORDER BY reference), '.') AS reference, COUNT(reference) AS many, COALESCE(MIN(s), 0) AS start, COALESCE(MAX(t), 0) AS end_, COALESCE(MAX(t - s), 0) AS max_reference_span, CAST(SUM(bp) AS BIGINT) AS seed_bp, CAST(SUM(n) AS BIGINT) AS nodes FROM per GROUP BY 1),
    chunks AS (SELECT chunk, reference, start, end_, max_reference_span, seed_bp, nodes, CASE WHEN many <= 1 AND max_reference_span <= 50000 AND seed_bp <= 60000 THEN 'PASS' ELSE concat_ws(',', CASE WHEN many > 1 THEN 'multiple_references' END, CASE WHEN max_reference_span > 50000 THEN 'reference_span_limit' END, CASE WHEN seed_bp > 60000 THEN 'seed_bases_limit' END) END AS status FROM sums)"""
)
_BACKBONE = ("backbone_nodes", "backbone_links")


def cut_graph(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    links, backbone = t.backbone_links, t.backbone_nodes.filter("reference is not null")
    bridges = graph.find_bridges(links)
    boundaries, cuts = graph.choose_cuts(backbone, links, bridges, 30_000, 4_000)
    return bridges, boundaries, cuts, graph.partition_graph(t.backbone_nodes, links, backbone, cuts, 60_000, 50_000)


@query("gr_5_bridges", f"+ {BRIDGES} SELECT left_id, left_end, right_id, right_end FROM bridge", _BACKBONE)
def _(t):
    return graph.find_bridges(t.backbone_links)


@query("gr_5_boundaries", f"+ {CUTS} SELECT reference, target, nearest_safe, distance, selected, CASE WHEN selected THEN 'bridge' ELSE 'no_bridge_within_slack' END AS reason FROM bounds", _BACKBONE)
def _(t):
    return cut_graph(t)[1]


@query("gr_5_partition", f"+ {CHUNKS} SELECT * FROM chunks", _BACKBONE)
def _(t):
    return cut_graph(t)[3]


@query(
    "gr_5_report",
    f"+ {CHUNKS} SELECT COUNT(*) AS chunks, COUNT(*) FILTER (status <> 'PASS') AS problems, COUNT(*) FILTER (reference = '.') AS off_reference_chunks, MAX(max_reference_span) AS largest_reference_span, MAX(seed_bp) AS largest_seed_bp, (SELECT COUNT(*) FROM bridge) AS bridges, (SELECT COUNT(*) FROM cut) AS cuts, COUNT(*) FILTER (status <> 'PASS') = 0 AS feasible FROM chunks",
    _BACKBONE,
)
def _(t):
    bridges, _, cuts, chunks = cut_graph(t)
    return graph.partition_report(chunks, bridges, cuts)


@query("agg_44_compare_builds", "+ a AS (SELECT sn, CAST(SUM(ln) AS BIGINT) AS v FROM segments WHERE sr <= 1 GROUP BY 1), b AS (SELECT sn, CAST(SUM(ln) AS BIGINT) AS v FROM segments WHERE sr >= 1 GROUP BY 1) SELECT COALESCE(a.sn, b.sn) AS sn, COALESCE(a.v, -1) AS left_value, COALESCE(b.v, -1) AS right_value, COALESCE(b.v - a.v, 0) AS difference, ROUND(b.v / CAST(a.v AS DOUBLE), 6) AS ratio FROM a FULL JOIN b ON a.sn = b.sn", ("segments",))
def _(t):
    sums = lambda c: t.segments.filter(c).groupBy("sn").agg(F.sum("ln").alias("v"))
    return compare.compare_builds(sums("sr <= 1"), sums("sr >= 1"), "sn", "v").fillna({"left_value": -1, "right_value": -1, "difference": 0})


@query("agg_27_shared_sites", "+ g AS (SELECT so % 5000 AS site, string_agg(DISTINCT sn, ';' ORDER BY sn) AS graphs, COUNT(DISTINCT sn) AS n_graphs FROM segments WHERE sr > 0 GROUP BY 1) SELECT site, graphs, n_graphs, CASE WHEN n_graphs = 7 THEN 'shared_all' WHEN n_graphs = 1 THEN graphs || '_only' ELSE 'shared_some' END AS sharing FROM g", ("segments",))
def _(t):
    return compare.shared_sites(t.segments.filter("sr > 0").select((F.col("so") % 5000).alias("site"), F.col("sn").alias("graph")), [f"donor{i}" for i in range(7)])


@query("agg_42_chunk_sizes", "+ g AS (SELECT n // 25 AS chunk, CAST(SUM(ln) AS BIGINT) AS bp, COUNT(CASE WHEN sr > 0 THEN sn END) AS alignments, COUNT(DISTINCT CASE WHEN sr > 0 THEN sn END) AS haplotypes FROM segments GROUP BY 1) SELECT *, CASE WHEN alignments = 0 THEN 'SEED_ONLY' WHEN bp > 110000 THEN 'OVERSIZED' ELSE 'PASS' END AS status FROM g", ("segments",))
def _(t):
    return graph.chunk_sizes(t.segments.select(F.expr("n div 25").alias("chunk"), F.col("ln").alias("bp"), F.when(F.col("sr") > 0, F.col("sn")).alias("assembly_id")), 110_000)


# intervals and annotation


def loci(t: Tables) -> DataFrame:
    return t.evidence.filter("discovery_method = 'graph_residual'").select(F.col("evidence_id").alias("locus_id"), "chromosome", F.col("position_0").alias("locus_start"), (F.col("position_0") + F.col("svlen")).alias("locus_end"))


LOCI = "lo AS (SELECT evidence_id AS locus_id, chromosome, position_0 AS s, position_0 + svlen AS e FROM evidence WHERE discovery_method = 'graph_residual')"


@query("jn_5_overlap_join", f"+ {LOCI} SELECT locus_id, feature_id FROM lo JOIN features f ON f.chromosome = lo.chromosome AND lo.s < f.end_ AND f.start < lo.e", ("evidence", "features"))
def _(t):
    return intervals.overlap_join(loci(t), t.features, ["chromosome"], "locus_start", "locus_end", "start", "end_").select("locus_id", "feature_id")


@query(
    "jn_6_nearest_all_ties",
    f"""+ {LOCI}, d AS (SELECT locus_id, feature_id, greatest(f.start - lo.e, lo.s - f.end_, 0) AS distance, MIN(greatest(f.start - lo.e, lo.s - f.end_, 0)) OVER (PARTITION BY locus_id) AS m FROM lo JOIN features f ON f.chromosome = lo.chromosome AND f.feature_type = 'gene') SELECT locus_id, feature_id, CAST(distance AS BIGINT) AS distance FROM d WHERE distance = m""",
    ("evidence", "features"),
)
def _(t):
    return intervals.nearest_join(loci(t), t.features.filter("feature_type = 'gene'"), ["chromosome"]).select("locus_id", "feature_id", "distance")


@query("jn_7_window_join", f"+ {LOCI}, d AS (SELECT locus_id, feature_id, greatest(f.start - lo.e, lo.s - f.end_, 0) AS distance FROM lo JOIN features f ON f.chromosome = lo.chromosome AND f.feature_type = 'tss') SELECT locus_id, feature_id, CAST(distance AS BIGINT) AS distance, CAST(CASE WHEN distance <= 2000 THEN 2000 WHEN distance <= 10000 THEN 10000 ELSE 20000 END AS BIGINT) AS within FROM d WHERE distance <= 20000", ("evidence", "features"))
def _(t):
    return intervals.window_join(loci(t), t.features.filter("feature_type = 'tss'"), ["chromosome"], 20_000, (2_000, 10_000, 20_000)).select("locus_id", "feature_id", "distance", "within")


@query(
    "jn_8_bed_context",
    """+ pt AS (SELECT evidence_id AS locus_id, chromosome, position_0 AS p FROM evidence WHERE svlen > 700), bd AS (SELECT * FROM features WHERE feature_type IN ('repeat', 'enhancer') AND chromosome <> 'chr4'),
    h AS (SELECT locus_id, string_agg(DISTINCT feature_type, ';' ORDER BY feature_type) AS l FROM pt JOIN bd USING (chromosome) WHERE greatest(p - 300, 0) < end_ AND start < p + 301 GROUP BY 1)
    SELECT locus_id, COALESCE(l, CASE WHEN chromosome IN (SELECT chromosome FROM bd) THEN 'NO_OVERLAP' ELSE 'CONTIG_NOT_IN_BED' END) AS context FROM pt LEFT JOIN h USING (locus_id)""",
    ("evidence", "features"),
)
def _(t):
    beds = t.features.filter("feature_type in ('repeat', 'enhancer') and chromosome <> 'chr4'").withColumn("label", F.col("feature_type"))
    return intervals.bed_context(t.evidence.filter("svlen > 700").select(F.col("evidence_id").alias("locus_id"), "chromosome", "position_0"), beds, 300)


@query(
    "agg_40_annotation_context",
    f"""+ {LOCI}, h AS (SELECT locus_id, feature_type, feature_id FROM lo JOIN features f ON f.chromosome = lo.chromosome AND lo.s < f.end_ AND f.start < lo.e),
    g AS (SELECT lo.locus_id, {", ".join(f"COALESCE(string_agg(CASE WHEN feature_type = '{x}' THEN feature_id END, ';' ORDER BY CASE WHEN feature_type = '{x}' THEN feature_id END), 'NO_OVERLAP') AS {x}" for x in ("gene", "exon", "repeat"))} FROM lo LEFT JOIN h USING (locus_id) GROUP BY 1)
    SELECT *, CASE WHEN exon <> 'NO_OVERLAP' THEN 'EXONIC' WHEN gene <> 'NO_OVERLAP' THEN 'GENIC' ELSE 'INTERGENIC' END AS gene_context FROM g""",
    ("evidence", "features"),
)
def _(t):
    return annotate.annotation_context(loci(t), t.features, ["gene", "exon", "repeat"])


@query(
    "jn_36_annotation_intervals",
    """+ lo AS (SELECT evidence_id AS locus_id, position_0 AS s, position_0 + svlen AS e FROM evidence)
    SELECT locus_id, part, q_start, q_end FROM (SELECT locus_id, 'locus' AS part, s AS q_start, e AS q_end FROM lo UNION ALL SELECT locus_id, 'left_edge', greatest(s - 1, 0), s + 1 FROM lo UNION ALL SELECT locus_id, 'right_edge', greatest(e - 1, 0), e + 1 FROM lo UNION ALL SELECT locus_id, 'left_flank', greatest(s - 5000, 0), s FROM lo UNION ALL SELECT locus_id, 'right_flank', e, e + 5000 FROM lo)""",
    ("evidence",),
)
def _(t):
    rows = t.evidence.select(F.col("evidence_id").alias("locus_id"), "chromosome", F.col("position_0").alias("start"), (F.col("position_0") + F.col("svlen")).alias("end_"))
    return annotate.annotation_queries(rows, 5000).select("locus_id", "part", "q_start", "q_end")


@query("win_14_boundaries", "+ c AS (SELECT chromosome, start AS cut FROM features), g AS (SELECT chromosome, t * 100000 AS target FROM (SELECT DISTINCT chromosome FROM features), range(1, 20) r(t)), d AS (SELECT g.chromosome, target, cut, ROW_NUMBER() OVER (PARTITION BY g.chromosome, target ORDER BY abs(cut - target), cut) AS r FROM g JOIN c ON c.chromosome = g.chromosome AND abs(cut - target) <= 2000) SELECT chromosome, target, cut FROM d WHERE r = 1", ("features",))
def _(t):
    cuts = t.features.select("chromosome", F.col("start").alias("cut"))
    targets = cuts.select("chromosome").distinct().select("chromosome", F.explode(F.sequence(F.lit(100_000).cast("long"), F.lit(1_900_000).cast("long"), F.lit(100_000).cast("long"))).alias("target"))
    return intervals.locate_in_cuts(targets, cuts, ["chromosome"], 2000)


@query(
    "jn_11_bubble_match",
    """+ pl AS (SELECT evidence_id AS event_id, chromosome, position_0 AS p FROM evidence WHERE svlen > 600) SELECT event_id, COUNT(DISTINCT f.feature_id) AS bubbles FROM pl LEFT JOIN features f ON f.chromosome = pl.chromosome AND (abs(p - f.start) <= 500 OR abs(p - f.end_) <= 500) GROUP BY 1""",
    ("evidence", "features"),
)
def _(t):
    plans = t.evidence.filter("svlen > 600").select(F.col("evidence_id").alias("event_id"), "chromosome", "position_0")
    return compare.bubble_match(plans, t.features.select(F.col("feature_id").alias("bubble_id"), "chromosome", "start", "end_"))
