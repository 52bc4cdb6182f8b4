"""Operator inputs derived from the supplied tables by integer arithmetic, as SQL that Spark and DuckDB both read.

`{d}` stands for integer division, `{all}` for what makes DuckDB replace all matches, `{name}` for a table. Spark gets a DataFrame from `frame`, the oracle a common table expression
from `cte`.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ADAPTERS = {
    "alignments": """
        SELECT 'asm'||CAST(s % 6 AS STRING) AS assembly_id, 'ctg'||CAST(o % 40 AS STRING) AS contig, qs AS qstart, qs + len AS qend, len AS block,
          len - (len * (p % 9)) {d} 100 AS matches, (s*7 + n*11 + p) % 61 AS mapq, n = 7 AS is_secondary, 'ref'||CAST(n % 2 AS STRING) AS reference,
          CASE WHEN p % 2 = 0 THEN '+' ELSE '-' END AS strand, (p*6007 + o*17) % 2000000 AS tstart, o*100 + n*10 + p % 10 AS aln_id
        FROM (SELECT l_suppkey AS s, l_orderkey AS o, l_partkey AS p, CAST(l_linenumber AS BIGINT) AS n,
                (l_partkey*7919 + l_linenumber*1009 + l_orderkey*31) % 2000000 AS qs, 500 + (l_orderkey*17 + l_partkey*13) % 4500 AS len FROM {lineitem})""",
    "nonhuman": """
        SELECT 'asm'||CAST(s % 6 AS STRING) AS assembly_id, 'ctg'||CAST(o % 40 AS STRING) AS contig, qs AS start, qs + len AS end_, 'grp'||f AS grp, 80 + (p % 20) AS identity
        FROM (SELECT l_suppkey AS s, l_orderkey AS o, l_partkey AS p, l_returnflag AS f,
                (l_partkey*6151 + l_linenumber*2003 + l_orderkey*37) % 2000000 AS qs, 200 + (l_orderkey*19 + l_partkey*11) % 2500 AS len FROM {lineitem}) WHERE o % 3 = 0""",
    "contigs": """
        SELECT DISTINCT 'asm'||CAST(l_suppkey % 6 AS STRING) AS assembly_id, 'ctg'||CAST(l_orderkey % 40 AS STRING) AS contig, CAST(2010000 AS BIGINT) AS length FROM {lineitem}""",
    "taxon_calls": """
        SELECT DISTINCT 'asm'||CAST(l_suppkey % 6 AS STRING) AS assembly_id, 'ctg'||CAST(l_orderkey % 40 AS STRING) AS contig,
          CASE WHEN (l_orderkey % 40) % 7 = 0 THEN 2 WHEN (l_orderkey % 40) % 7 = 1 THEN 10239 ELSE 9606 END AS taxid FROM {lineitem}""",
    "assemblies": """
        SELECT 'S'||CAST(c {d} 2 AS STRING) AS sample, 'hap'||CAST(1 + c % 2 AS STRING) AS haplotype, 'S'||CAST(c {d} 2 AS STRING)||'.hap'||CAST(1 + c % 2 AS STRING) AS assembly_id,
          2500000000 + (k*7919) % 900000000 AS total_length_bp, 100000 + (k*31) % 60000000 AS contig_n50_bp, CAST((k*13) % 300 AS DOUBLE) / 100 AS n_percent,
          CAST(80 + (k*7) % 20 AS DOUBLE) AS compleasm_complete_percent, CAST((k*3) % 12 AS DOUBLE) AS compleasm_duplicated_percent, CAST(85 + (k*11) % 15 AS DOUBLE) AS best_query_aligned_percent,
          CAST(85 + k % 15 AS DOUBLE) AS best_reference_covered_percent, CAST(97 + k % 3 AS DOUBLE) AS best_alignment_identity_percent,
          CAST((k*37) % 5000 AS DOUBLE) / 100000 AS mash_distance, CAST(850 + (k*17) % 150 AS DOUBLE) / 1000 AS hash_fraction, k % 5 = 0 AS graph_member, k
        FROM (SELECT o_custkey AS c, CAST(SUM(o_orderkey) AS BIGINT) AS k FROM {orders} GROUP BY o_custkey)""",
    "evidence": """
        SELECT CASE WHEN l_returnflag = 'A' THEN 'GRAPH' ELSE 'REF' END AS frame, 'chr'||CAST(1 + l_suppkey % 5 AS STRING) AS chromosome,
          (l_partkey*4001 + l_orderkey*53) % 2000000 AS position_0, CASE l_linenumber % 3 WHEN 0 THEN 'INS' WHEN 1 THEN 'DEL' ELSE 'DUP' END AS svtype,
          50 + (l_partkey*l_linenumber) % 900 AS svlen,
          CAST(l_orderkey AS STRING)||':'||CAST(l_linenumber AS STRING)||':'||CAST(l_partkey AS STRING)||':'||CAST(l_suppkey AS STRING)||':'||l_linestatus||':'||CAST(CAST(l_quantity AS BIGINT) AS STRING)||':'||CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING) AS evidence_id,
          'S'||CAST(l_orderkey % 50 AS STRING) AS sample_id, 'hap'||CAST(1 + l_linenumber % 2 AS STRING) AS haplotype,
          'S'||CAST(l_orderkey % 50 AS STRING)||'.hap'||CAST(1 + l_linenumber % 2 AS STRING) AS assembly_id,
          CASE WHEN l_linestatus = 'O' THEN 'graph_residual' ELSE 'assembly_caller' END AS discovery_method, CASE WHEN l_linestatus = 'O' THEN 'graph' ELSE 'caller'||CAST(l_suppkey % 2 AS STRING) END AS caller,
          l_orderkey % 5 = 0 AS graph_member,
          CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_partkey % 3 = 0 THEN 'HIGH_CONFIDENCE' ELSE 'REVIEW' END ELSE CASE WHEN l_partkey % 4 = 0 THEN 'CALLER_PASS' ELSE 'CALLER_FILTERED' END END AS confidence_tier,
          CASE l_suppkey % 4 WHEN 0 THEN 'fragmented_rescue' WHEN 1 THEN 'not_recommended' WHEN 2 THEN 'primary' ELSE '' END AS qc_tier
        FROM {lineitem}""",
    "cigars": """
        SELECT aln_id, qstart, tstart, mapq, block, identity, is_primary, assembly_id,
          CAST(a AS STRING)||'M'||CAST(20 + p % 60 AS STRING)||'I'||CAST(5 + s % 60 AS STRING)||'M'||CAST(20 + k % 60 AS STRING)||'D'||CAST(c AS STRING)||'M' AS cigar
        FROM (SELECT o*100 + n*10 + p % 10 AS aln_id, o AS k, p, s, 2000 + o % 500 AS a, 2100 + p % 300 AS c, o % 1000 AS qstart, p % 1000 AS tstart, (s*7 + p) % 61 AS mapq,
                900 + (o*17) % 9000 AS block, CAST(80 + p % 20 AS DOUBLE) / 100 AS identity, n <> 7 AS is_primary, 'asm'||CAST(s % 6 AS STRING) AS assembly_id
              FROM (SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, CAST(l_linenumber AS BIGINT) AS n, ROW_NUMBER() OVER (PARTITION BY l_orderkey*100 + l_linenumber*10 + l_partkey % 10 ORDER BY l_partkey, l_suppkey, l_extendedprice) AS r FROM {lineitem}) WHERE r = 1)""",
    "segments": """
        SELECT 's'||CAST(p_partkey AS STRING) AS segment_id, p_partkey AS n, 1 + (p_partkey*37) % 9000 AS ln, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 + p_partkey % 3 END AS sr,
          CASE WHEN p_partkey % 4 = 0 THEN 'chr'||CAST(1 + (p_partkey {d} 25) % 5 AS STRING) ELSE 'donor'||CAST(p_partkey % 7 AS STRING) END AS sn, (p_partkey*101) % 500000 AS so
        FROM {part}""",
    "links": """
        SELECT 's'||CAST(a AS STRING) AS left_id, 's'||CAST(b AS STRING) AS right_id, a % 2 = 0 AS left_forward, CASE WHEN a % 4 = 0 THEN 0 ELSE 1 + a % 3 END AS sr
        FROM (SELECT p_partkey AS a, p_partkey + 1 AS b FROM {part} WHERE p_partkey % 25 <> 0
              UNION ALL SELECT p_partkey, p_partkey + 7 FROM {part} WHERE p_partkey % 5 = 0 AND (p_partkey - 1) {d} 25 = (p_partkey + 6) {d} 25)
        WHERE b <= (SELECT MAX(p_partkey) FROM {part})""",
    "backbone_nodes": """
        SELECT 's'||CAST(n AS STRING) AS segment_id, n, ln, CASE WHEN n % 3 <> 0 THEN 'c'||CAST(g AS STRING) END AS reference, CASE WHEN n % 3 <> 0 THEN CAST(before AS BIGINT) - ln END AS start, CASE WHEN n % 3 <> 0 THEN CAST(before AS BIGINT) END AS end_
        FROM (SELECT n, ln, g, SUM(CASE WHEN n % 3 <> 0 THEN ln ELSE 0 END) OVER (PARTITION BY g ORDER BY n) AS before FROM (SELECT p_partkey AS n, 1 + (p_partkey*37) % 9000 AS ln, p_partkey {d} 60 AS g FROM {part}))""",
    "backbone_links": """
        SELECT 's'||CAST(CASE WHEN back THEN b ELSE a END AS STRING) AS left_id, NOT back AS left_forward, 's'||CAST(CASE WHEN back THEN a ELSE b END AS STRING) AS right_id, NOT back AS right_forward
        FROM (SELECT a, b, false AS back FROM (
                SELECT p_partkey AS a, p_partkey + CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 2 END AS b FROM {part} WHERE p_partkey % 3 <> 0
                UNION ALL SELECT p_partkey - 1, p_partkey FROM {part} WHERE p_partkey % 6 = 0 OR p_partkey % 5 = 0 AND p_partkey % 3 = 0
                UNION ALL SELECT p_partkey, p_partkey + 1 FROM {part} WHERE p_partkey % 6 = 0 AND p_partkey % 4 <> 0
                UNION ALL SELECT p_partkey, p_partkey + 9 FROM {part} WHERE p_partkey % 30 = 1) x
              UNION ALL SELECT p_partkey, p_partkey + 1, true FROM {part} WHERE p_partkey % 30 = 1) y
        WHERE a > 0 AND a {d} 60 = b {d} 60 AND b <= (SELECT MAX(p_partkey) FROM {part})""",
    "gaf": """
        SELECT 'r'||CAST(event_id {d} 2 AS STRING)||'/'||CAST(1 + event_id % 2 AS STRING) AS read_name, '>s'||CAST(1 + user_id % 20 AS STRING)||'>s'||CAST(2 + user_id % 20 AS STRING)||(CASE WHEN event_id % 7 < 3 THEN '>' ELSE '<' END)||'s'||CAST(3 + (user_id + event_id % 3) % 20 AS STRING) AS path,
          (event_id*7) % 256 AS mapq, 'g'||CAST((event_id {d} 2) % 4 AS STRING) AS target, 'S'||CAST(user_id % 20 AS STRING) AS sample_id, event_id,
          150 AS qlen, event_id % 20 AS qstart, 150 - event_id % 13 AS qend, 130 - event_id % 9 AS matches, 130 + event_id % 11 AS block, event_id % 17 = 0 AS is_secondary
        FROM {events}""",
    "features": """
        SELECT 'chr'||CAST(1 + p_partkey % 5 AS STRING) AS chromosome, (p_partkey*9973) % 2000000 AS start, (p_partkey*9973) % 2000000 + 1 + p_size*200 AS end_, 'f'||CAST(p_partkey AS STRING) AS feature_id,
          CASE p_partkey % 5 WHEN 0 THEN 'gene' WHEN 1 THEN 'exon' WHEN 2 THEN 'tss' WHEN 3 THEN 'enhancer' ELSE 'repeat' END AS feature_type, p_brand AS gene_id, p_partkey AS n FROM {part}""",
    "people": """
        SELECT c_custkey AS person, 'P'||CAST(c_custkey AS STRING) AS person_id, CASE c_custkey % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN 'no' WHEN 2 THEN 'no' ELSE 'yes' END AS consent,
          CASE (c_custkey {d} 7) % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'no' ELSE 'yes' END AS sequenced, c_mktsegment AS phenotype, 'B'||CAST(c_nationkey AS STRING) AS batch, 10 + (c_custkey*37) % 50 AS depth,
          CASE WHEN (c_custkey*11) % 3 = 0 THEN 1 ELSE 0 END AS carrier, CASE WHEN (c_custkey*13) % 4 = 0 THEN 1 ELSE 0 END AS affected FROM {customer}""",
    "sequences": """
        SELECT doc_id AS contig, translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ ', 'AACACGGTACGTANGTACGTACGTACAACACGGTACGTANGTACGTACGTACN') AS seq FROM {documents}""",
    "repeat_calls": """
        SELECT 'f'||CAST(c AS STRING) AS file, v AS variant, 'chr'||CAST(1 + v % 5 AS STRING) AS chromosome, v*1000 + CASE WHEN o % 23 = 0 THEN 1 ELSE 0 END AS pos, v*1000 + 30 AS end_,
          CASE o % 9 WHEN 0 THEN 'LowDepth' WHEN 1 THEN 'q10;LowDepth' WHEN 2 THEN 'q10' ELSE 'PASS' END AS filter, CASE c % 7 WHEN 0 THEN './.' WHEN 1 THEN '1' WHEN 2 THEN './1' ELSE '0/1' END AS gt,
          CASE o % 11 WHEN 0 THEN './.' WHEN 1 THEN '7' WHEN 2 THEN '12/x' ELSE CAST(5 + o % 20 AS STRING)||'/'||CAST(9 + c % 20 AS STRING) END AS repcn,
          CASE WHEN c % 5 = 0 THEN '.' WHEN o % 11 = 1 THEN '4-9' ELSE '4-40/8-'||CAST(20 + o % 12 AS STRING) END AS repci,
          v % 9 <> 8 AS catalog_found, 'chr'||CAST(1 + v % 5 AS STRING) AS catalog_chromosome, v*1000 AS catalog_start, v*1000 + 30 AS catalog_end
        FROM (SELECT o_orderkey AS o, o_custkey AS c, (o_orderkey*7) % 60 AS v, ROW_NUMBER() OVER (PARTITION BY o_custkey, (o_orderkey*7) % 60 ORDER BY o_orderkey) AS r FROM {orders}) WHERE r = 1""",
    "cn_segments": """
        SELECT 'f'||CAST(l_suppkey AS STRING) AS file, CAST(l_orderkey AS STRING)||':'||CAST(l_linenumber AS STRING)||':'||CAST(l_partkey AS STRING)||':'||CAST(l_suppkey AS STRING) AS record_id,
          (l_partkey*31) % 1000000 + CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE 1 END AS pos, (l_partkey*31) % 1000000 + l_orderkey % 500 AS end_,
          CASE l_linenumber % 4 WHEN 0 THEN '<DEL>' WHEN 1 THEN '<DUP>' WHEN 2 THEN '.' ELSE '<INS>' END AS alt, CASE l_partkey % 4 WHEN 0 THEN './.' WHEN 1 THEN '0/0' WHEN 2 THEN '0' ELSE '0|1' END AS gt,
          CASE l_suppkey % 5 WHEN 0 THEN '.' WHEN 1 THEN '-1' ELSE CAST(l_suppkey % 5 AS STRING) END AS cn FROM {lineitem}""",
    "bubbles": """
        SELECT p_partkey AS n, (p_partkey*13) % 400 AS reference_length, (p_partkey*29) % 500 AS shortest, (p_partkey*29) % 500 + (p_partkey*7) % 600 AS longest, p_partkey % 11 = 0 AS bidirectional FROM {part}""",
    "cells": """
        SELECT 'P'||CAST(c AS STRING) AS person_id, 'A'||CAST(a AS STRING) AS allele_id, o, CASE o % 5 WHEN 0 THEN 'UNRESOLVED' WHEN 1 THEN 'RESOLVED_GENOTYPE' ELSE 'RESOLVED_CARRIER' END AS status,
          CASE WHEN o % 3 = 0 THEN 'REF_SUPPORTED' ELSE 'ALT_SUPPORTED' END AS truth, CASE WHEN c % 2 = 0 THEN 'development' ELSE 'held_out' END AS validation_set,
          CASE WHEN o % 7 = 0 THEN 'no' ELSE 'yes' END AS callable, CASE WHEN (o + c) % 4 = 0 THEN 'REF_SUPPORTED' ELSE 'ALT_SUPPORTED' END AS carrier_status
        FROM (SELECT o_orderkey AS o, o_custkey AS c, o_orderkey % 25 AS a, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderkey % 25 ORDER BY o_orderkey) AS r FROM {orders}) WHERE r = 1""",
    "donors": """
        SELECT 'P'||CAST(c_custkey AS STRING) AS person_id, CASE c_custkey % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'unknown' ELSE 'no' END AS discovery_donor, CASE c_custkey % 11 WHEN 0 THEN 'yes' WHEN 1 THEN 'unknown' ELSE 'no' END AS related_to_discovery_donor,
          CASE c_custkey % 4 WHEN 0 THEN 'no' ELSE 'yes' END AS analysis_eligible, CASE c_custkey % 5 WHEN 0 THEN 'unknown' ELSE 'yes' END AS unrelated_primary FROM {customer}""",
    "path_alignments": """
        SELECT event_id AS aln_id, 'S'||CAST(user_id % 20 AS STRING) AS sample_id, CASE WHEN event_id % 50 = 0 THEN 's'||CAST(1 + user_id % 30 AS STRING) ELSE '>s'||CAST(1 + user_id % 20 AS STRING)||'>s'||CAST(2 + user_id % 20 AS STRING)||'<s'||CAST(3 + (user_id + event_id % 3) % 20 AS STRING) END AS path,
          (event_id % 5) * 100 AS tstart, (event_id % 5) * 100 + 15000 AS tend, event_id % 17 = 0 OR event_id % 4 = 1 AS is_secondary, event_id % 90 AS max_indel, event_id % 40 AS clip FROM {events}""",
    "path_events": """
        SELECT 'e'||CAST(p_partkey AS STRING) AS event_id, (CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE 's' END)||CAST(p_partkey AS STRING) AS graph_segment, (p_partkey*17) % 9000 AS segment_offset, p_partkey AS n FROM {part}""",
    "path_segments": """
        SELECT 's'||CAST(p_partkey AS STRING) AS segment_id, 1 + (p_partkey*37) % 9000 AS ln, CASE WHEN p_partkey % 3 = 0 THEN 'x'||CAST(p_partkey AS STRING) END AS alias, CASE WHEN p_partkey % 5 = 0 THEN 'e'||CAST(p_partkey + 1 AS STRING) END AS event_id, p_partkey % 9 = 4 AS novel FROM {part}""",
    "simulated": """
        SELECT assembly_id, 'sim|S'||CAST(o % 50 AS STRING)||'|hap'||CAST(o % 2 AS STRING)||'|chr'||CAST(o % 5 AS STRING)||':'||CAST((o*53) % 2000000 AS STRING)||'-'||CAST((o*53) % 2000000 + 15000 AS STRING)||'|'||CAST(o AS STRING) AS read_name,
          CASE a % 4 WHEN 0 THEN 'chr'||CAST(o % 5 AS STRING) WHEN 1 THEN CAST((o + a) % 5 AS STRING) WHEN 2 THEN '>CHM13#chr'||CAST(o % 5 AS STRING)||':'||CAST(ts AS STRING)||'-'||CAST(ts + block AS STRING)||'<x' ELSE '>S'||CAST(o % 50 AS STRING)||'.hap'||CAST(a % 2 AS STRING)||'.chr'||CAST(o % 5 AS STRING) END AS path,
          15000 AS qlen, a % 300 AS qstart, 15000 - a % 700 AS qend, CASE WHEN a % 4 = 2 THEN 0 ELSE ts END AS tstart, CASE WHEN a % 4 = 2 THEN block ELSE ts + block END AS tend, matches, block, mapq, is_secondary, o, ts, a
        FROM (SELECT a.*, aln_id {d} 100 AS o, aln_id AS a, CASE WHEN strand = '+' THEN ((aln_id {d} 100)*53) % 2000000 + aln_id % 20000 ELSE tstart END AS ts FROM (
          SELECT 'asm'||CAST(l_suppkey % 6 AS STRING) AS assembly_id, 500 + (l_orderkey*17 + l_partkey*13) % 4500 AS block, 400 + (l_orderkey*17 + l_partkey*13) % 4500 AS matches, (l_suppkey*7 + l_linenumber*11 + l_partkey) % 61 AS mapq, l_linenumber = 7 AS is_secondary,
            CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, (l_partkey*6007 + l_orderkey*17) % 2000000 AS tstart, l_orderkey*100 + l_linenumber*10 + l_partkey % 10 AS aln_id FROM {lineitem}) a)""",
    "crosswalk_contigs": """
        SELECT 'A'||CAST(o_custkey AS STRING) AS assembly_id, 'c'||CAST(CASE WHEN o_orderkey % 301 = 0 THEN 0 ELSE o_orderkey END AS STRING) AS contig_id, 'h'||CAST(o_orderkey AS STRING)||' len' AS original_header,
          (CASE WHEN o_orderkey % 97 = 0 THEN 'Z' ELSE 'S' END)||CAST(o_custkey AS STRING)||'#1#'||CAST(CASE WHEN o_orderkey % 151 = 0 THEN 0 ELSE o_orderkey END AS STRING) AS panel_name, CASE WHEN o_orderkey % 211 = 0 THEN 0 ELSE 1000 + o_orderkey % 777 END AS length, o_custkey AS c FROM {orders}""",
    "crosswalk_manifest": """
        SELECT 'A'||CAST(c_custkey AS STRING) AS assembly_id, 'S'||CAST(c_custkey AS STRING) AS sample, '1' AS haplotype, COUNT(o_orderkey) + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS contig_count,
          CAST(COALESCE(SUM(CASE WHEN o_orderkey % 211 = 0 THEN 0 ELSE 1000 + o_orderkey % 777 END), 0) AS BIGINT) AS total_bases FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey WHERE c_custkey % 13 <> 5 GROUP BY c_custkey""",
    "placements": """
        SELECT 'f'||CAST(n AS STRING) AS query_id, 'chr'||CAST(1 + (n + CASE WHEN a % 6 = 0 THEN 1 ELSE 0 END) % 5 AS STRING) AS chromosome, 2200 AS qlen, a % 150 AS qstart, 2200 - a % 130 AS qend,
          (n*9973) % 2000000 + a % 6000 - 3000 AS tstart, (n*9973) % 2000000 + a % 6000 - 800 AS tend, (a*7) % 256 AS mapq
        FROM (SELECT l_orderkey*7 + l_linenumber AS a, l_partkey AS n FROM {lineitem})""",
    "variants": """
        SELECT *, COALESCE('SVTYPE='||info_svtype||';', '')||COALESCE('SVLEN='||info_svlen||';', '')||COALESCE('END='||info_end||';', '')||'PRECISE' AS info FROM (
          SELECT l_orderkey AS o, CAST(l_linenumber AS BIGINT) AS n, l_partkey AS p, l_suppkey AS s, 'chr'||CAST(1 + l_partkey % 5 AS STRING) AS chromosome, 1 + (l_partkey*31 + l_linenumber) % 100000 AS pos,
            CASE WHEN l_orderkey % 3 = 0 THEN '.' ELSE 'v'||CAST(l_orderkey AS STRING)||'_'||CAST(l_linenumber AS STRING) END AS id, CASE WHEN l_partkey % 4 = 1 THEN 'ACGTACGT' ELSE 'A' END AS ref,
            CASE l_partkey % 4 WHEN 0 THEN 'ACGTTGCA' WHEN 1 THEN 'A' WHEN 2 THEN CASE l_linenumber % 3 WHEN 0 THEN '<INS>' WHEN 1 THEN '<DEL>' ELSE '<DUP:TANDEM>' END ELSE 'A[chr2:321[' END AS alt,
            CASE WHEN l_suppkey % 2 = 0 THEN 'PASS' ELSE 'LowQual' END AS filter, CASE l_orderkey % 4 WHEN 0 THEN 'INS' WHEN 1 THEN 'del' END AS info_svtype,
            CASE l_orderkey % 4 WHEN 0 THEN '-'||CAST(50 + l_partkey % 900 AS STRING) WHEN 3 THEN CAST(50 + l_partkey % 900 AS STRING)||',7' END AS info_svlen,
            CASE WHEN l_orderkey % 4 = 1 THEN CAST(61 + (l_partkey*31 + l_linenumber) % 100000 + l_partkey % 40 AS STRING) END AS info_end,
            ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) + l_orderkey * 1000 AS row
          FROM {lineitem})""",
    "taxa": """
        SELECT 'f'||CAST(p_partkey {d} 100 AS STRING) AS report, p_partkey % 100 AS line, (p_partkey % 100) % 5 AS depth, p_partkey AS taxid, CASE p_partkey % 7 WHEN 0 THEN 'bacteria' WHEN 3 THEN 'virus' END AS own, p_size AS clade FROM {part}""",
    "edits": """
        SELECT l_orderkey AS read_id, r AS step, '>n'||CAST((l_orderkey + r) % 30 AS STRING) AS node, l_partkey % 5 <> 0 AS exact, 5 + l_suppkey % 20 AS length, r = 1 OR l_partkey % 3 <> 0 AS new_node
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM {lineitem})""",
    "bases": """
        SELECT doc_id AS contig, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ ', 'AACACGGTACGTANGTACGTACGTACAACACGGTACGTANGTACGTACGTACN'), '[^ACGTN]', ''{all}) AS seq FROM {documents} WHERE text IS NOT NULL""",
}

# The same evidence with what a catalogue row shows of it; insertions with a sequence meet only their like.
ADAPTERS["catalog_evidence"] = f"""
        SELECT e.*, position_0 + CASE WHEN svtype = 'INS' THEN 1 ELSE svlen END AS end_0, CASE WHEN svtype = 'INS' AND svlen % 4 <> 0 THEN CASE WHEN svlen % 2 = 0 THEN 'ACGTACGT' ELSE 'TTGACA' END ELSE '' END AS alternate_sequence,
          CASE WHEN chromosome = 'chr5' THEN CASE WHEN svlen % 2 = 0 THEN 'XY' ELSE 'X' END ELSE '' END AS sex_chromosome_status, CASE WHEN discovery_method = 'graph_residual' THEN 's'||CAST(position_0 % 97 AS STRING) ELSE '' END AS graph_segment,
          CASE WHEN discovery_method = 'graph_residual' THEN position_0 % 1000 END AS segment_offset_0
        FROM ({ADAPTERS["evidence"]}) e"""


def _tables(text: str) -> set[str]:
    return set(re.findall(r"\{(\w\w+)\}", text)) - {"all"}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = ADAPTERS[name]
    return spark.sql(text.replace("{d}", "div").replace("{all}", ""), **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _tables(text)})


def cte(*names: str) -> str:
    """WITH clause for DuckDB."""
    parts = []
    for name in names:
        text = ADAPTERS[name].replace("{d}", "//").replace("{all}", ", 'g'")
        parts.append(f"{name} AS ({text.format(**{t: t for t in _tables(text)})})")
    return "WITH RECURSIVE " + ", ".join(parts)
