import hashlib
import itertools
import random
import re
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspan.functions import columns as C
from cohortspan.operators import alignments as A
from cohortspan.operators import alleles, annotate, calls, catalog, checks, cohort, evidence, graph, intervals, kernels, qc, stats
from cohortspan.operators.components import components, running_totals


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_cigar_event_literals(spark):
    df = spark.createDataFrame([("a", "2500M60I3000M", 0, 0), ("b", "2100M30I10M25D2100M", 0, 0), ("c", "60I6000M", 0, 0), ("d", "2100M10I60M25D2100M", 0, 0)], "id string, cigar string, qstart long, tstart long")
    got = {}
    for r in A.cigar_events(df).collect():
        got.setdefault(r.id, []).append((r.kind, r.operation, r.length, r.svlen, r.left_anchor, r.right_anchor))
    assert got == {
        "a": [("atomic", "I", 60, 60, 2500, 3000)],
        "b": [("atomic", "I", 30, 30, 2100, 2110), ("cluster", "ID", 55, 5, 2100, 2100)],
        "c": [("atomic", "I", 60, 60, 0, 6000)],
    }


def plain_events(cigar, query, target, raw_min, gap, cluster_min):
    """One CIGAR, operation by operation."""
    aligned, indels, out = 0, [], []
    for n, op in re.findall("([0-9]+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op in "ID":
            indels.append((op, n, query, target, aligned))
        query, target, aligned = query + n * (op in "M=XIS"), target + n * (op in "M=XDN"), aligned + n * (op in "M=X")
    out += [("atomic", op, n, n if op == "I" else -n, q, t, 1, a, aligned - a) for op, n, q, t, a in indels if n >= raw_min]
    runs = []
    for x in indels:
        if runs:
            op, n, q, t, _ = runs[-1][-1]
            if max(x[2] - q - n * (op == "I"), x[3] - t - n * (op == "D")) <= gap:
                runs[-1].append(x)
                continue
        runs.append([x])
    for r in runs:
        ins, del_ = (sum(n for op, n, *_ in r if op == k) for k in "ID")
        if len(r) > 1 and ins + del_ >= cluster_min:
            out.append(("cluster", "I" if not del_ else "D" if not ins else "ID", ins + del_, ins - del_, r[0][2], r[0][3], len(r), r[0][4], aligned - r[-1][4]))
    return out


def test_cigar_events_against_plain_reading(spark, monkeypatch):
    """Random CIGARs with every operation, clips, null and odd texts, among them one of 200,000 operations; in one piece and in small ones."""
    rng = random.Random(3)
    cigars = ["".join(f"{rng.choice([1, 5, 12, 30, 55, 400])}{rng.choice('MMM=XIIDDNSHP')}" for _ in range(rng.randrange(25))) for _ in range(400)]
    cigars += ["", "*", "12", "M", "5M3", "7Z30I10M", "é9I", "0I5M", "".join(f"{1 + i % 60}{'MID='[i % 4]}" for i in range(200_000))]
    data = [(i, c, i * 7, i * 3) for i, c in enumerate(cigars)] + [(-1, None, 1, 1), (-2, "99I", None, 1)]
    df = spark.createDataFrame(data, "id long, cigar string, qstart long, tstart long").withColumn("kind", F.lit("own"))
    want = sorted((i, *e) for i, c, q, t in data if c is not None and q is not None for e in plain_events(c, q, t, 30, 50, 50))
    for size in (1 << 24, 100):
        monkeypatch.setattr(A, "_CIGAR_BYTES", size)
        got = A.cigar_events(df, keep=["id"])
        assert got.columns == ["id", "kind", "operation", "length", "svlen", "query_position", "target_position", "members", "left_anchor", "right_anchor"]
        assert sorted(map(tuple, got.collect())) == want
    assert A.cigar_events(df.limit(0)).collect() == [] and A.cigar_events(df).columns[:5] == df.columns


def test_intervals_abut_and_properties(spark):
    random.seed(5)
    data = [("k", s, s + random.randrange(1, 30)) for s in (random.randrange(300) for _ in range(60))]
    df = spark.createDataFrame(data, "k string, start long, end_ long")
    covered = {p for _, s, e in data for p in range(s, e)}
    merged = intervals.merge_intervals(df, ["k"])
    assert merged.agg(F.sum(F.col("end_") - F.col("start"))).first()[0] == len(covered)
    assert rows(intervals.merge_intervals(merged, ["k"]), "start", "end_") == rows(merged, "start", "end_")
    other = spark.createDataFrame([("k", 50, 120), ("k", 119, 200)], "k string, start long, end_ long")
    both = intervals.intersection_length(df, other, ["k"]).first().shared_bp
    assert both == len(covered & set(range(50, 200))) == intervals.intersection_length(other, df, ["k"]).first().shared_bp
    rest = intervals.complement_intervals(df, spark.createDataFrame([("k", 400), ("z", 5)], "k string, length long"), ["k"])
    assert rest.filter("k = 'k'").agg(F.sum(F.col("end_") - F.col("start"))).first()[0] == 400 - len(covered)
    assert rows(rest.filter("k = 'z'"), "start", "end_") == [(0, 5)]


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("gap", [0, 5])
def test_unions_in_bins_of_any_width(spark, width, gap):
    """Merged intervals, lengths of two sets and the longest block against plain sweeps, with empty, abutting, nested and very long intervals."""
    rng = random.Random(width + gap)
    data = [(rng.choice("ab"), s, s + rng.choice([0, 0, 1, 3, 20, 150]), rng.random() < 0.5) for s in (rng.randrange(900) for _ in range(150))] + [("b", 100, 700, True), ("c", 5, 5, True)]
    df = spark.createDataFrame(data, "k string, start long, end_ long, one boolean")

    def plain(rows_, gap):
        out = []
        for s, e in sorted(rows_):
            if out and s <= out[-1][1] + gap:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        return out

    want = sorted((k, s, e) for k in "abc" for s, e in plain([r[1:3] for r in data if r[0] == k], gap))
    assert rows(intervals.merge_intervals(df, ["k"], gap=gap, width=width), "k", "start", "end_") == want
    got = {r.k: r for r in intervals.union_lengths(df, ["k"], {"n": F.col("one"), "every": F.lit(True)}, largest={"longest": "n", "whole": "every"}, width=width).collect()}
    for k in "abc":
        some, every = (plain([r[1:3] for r in data if r[0] == k and (r[3] or all_)], 0) for all_ in (False, True))
        assert (got[k].n, got[k].every) == (sum(e - s for s, e in some), sum(e - s for s, e in every))
        assert (got[k].longest, got[k].whole) == (max((e - s for s, e in some), default=None), max(e - s for s, e in every))


def plain_greedy(data, distance, similarity):
    """Head of each id, by comparing every row with all heads before it."""
    heads, out = [], {}
    for frame, chromosome, position, kind, length, name, bases in sorted(data, key=lambda r: (r[2], r[3], r[4], r[5])):
        for h in reversed(heads):
            near = h[:2] == (frame, chromosome) and h[3] == kind and position - h[2] <= distance
            sizes = sorted((length, h[4]))
            if near and (sizes[0] == 0 or sizes[0] / sizes[1] >= similarity) and (not bases or not h[6] or bases == h[6]):
                out[name] = h[5]
                break
        else:
            heads.append((frame, chromosome, position, kind, length, name, bases))
            out[name] = name
    return out


def plain_chains(data, distance, length_sim, seq_sim):
    """The last row of each row's cluster: every pair compared, the later row's sequence first."""
    rows_ = sorted(data, key=lambda r: (r[2], r[0]))
    parent = list(range(len(rows_)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, chromosome, place, kind, length, bases) in enumerate(rows_):
        for j, (_, c, p, k, n, b) in enumerate(rows_[:i]):
            small, large = sorted((abs(length), abs(n)))
            if (c, k) == (chromosome, kind) and place - p <= distance and (small / large if large else 1.0) >= length_sim:
                if not (bases and b) or bases == b or SequenceMatcher(None, bases, b).ratio() >= seq_sim:
                    parent[root(j)] = root(i)
    return {r[0]: "SVC_" + hashlib.sha256(rows_[root(i)][0].encode()).hexdigest()[:12] for i, r in enumerate(rows_)}


@pytest.mark.parametrize(("span", "distance", "length_sim", "seq_sim"), [(60_000, 500, 0.7, 0.8), (2_000, 20, 0.7, 0.8), (300, 0, 0.9, 0.5), (5_000, 60, 1.0, 0.9)])
def test_transitive_clusters_against_all_pairs(spark, span, distance, length_sim, seq_sim):
    rng = random.Random(span)
    bases = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(5, 30))) for _ in range(4)]

    def changed(s):
        at = rng.randrange(len(s))
        return s[:at] + rng.choice(["", "A", "GG"]) + s[at + rng.randrange(3) :]

    data = [(f"e{i}", rng.choice(["c1", "c2"]), rng.randrange(span), rng.choice(["INS", "DEL"]), rng.choice([0, 7, 10, 11, 50, -50, 70, 100, rng.randrange(1, 900)]), rng.choice(["", "", changed(rng.choice(bases)), changed(changed(rng.choice(bases)))])) for i in range(350)]
    want = plain_chains(data, distance, length_sim, seq_sim)
    rest = [("n1", None, 5, "INS", 50, ""), ("n2", "c1", None, "INS", 50, ""), ("n3", "c1", 5, "INS", None, None)]
    schema = "event_id string, chromosome string, position_0 long, svtype string, svlen long, alternate_sequence string"
    df = spark.createDataFrame(data + rest, schema).repartition(3).withColumns({"id": F.lit(1), "len": F.lit("x"), "a": F.lit(2)})
    got = {r.event_id: r.cluster_id for r in catalog.cluster_transitive(df, distance, length_sim, seq_sim).collect()}
    assert got == want | {"n1": "", "n2": "", "n3": ""}
    if distance == 500:
        bare = [(*r[:5], "") for r in data]
        got = catalog.cluster_transitive(df.drop("alternate_sequence").limit(400)).collect()
        assert {r.event_id: r.cluster_id for r in got if r.cluster_id} == plain_chains(bare, 500, 0.7, 0.8)
        assert catalog.cluster_transitive(df.limit(0)).collect() == []


@pytest.mark.parametrize("task_links", [5, 40, 10_000])
def test_bridges_of_random_graphs(spark, task_links):
    """A range at a time, with parallel links, loops, reverse readings, long paths and names without any order, against the plain search."""
    rng = random.Random(task_links)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(110)] + [(200 + i, 201 + i) for i in range(60)] + [(300 + i, 300 + (i + 1) % 25) for i in range(25)] + [(230, 310), (5, 200), (7, 7), (400, 401), (400, 401)]
    names = rng.sample(range(1000), 500)
    rows = [(f"n{names[a]}", f"n{names[b]}", rng.random() < 0.7, rng.random() < 0.7) for a, b in edges]
    rows += [(b, a, not y, not x) for a, b, x, y in rows[:30]]
    links = spark.createDataFrame(rows, "left_id string, right_id string, left_forward boolean, right_forward boolean")
    plain = sorted({tuple(sorted([(a, "right" if x else "left"), (b, "left" if y else "right")])) for a, b, x, y in rows})
    number = {}
    ends = [(number.setdefault(a[0], len(number)), number.setdefault(b[0], len(number))) for a, b in plain]
    want = {(*plain[i][0], *plain[i][1]) for i in kernels.bridges(ends) if ends[i][0] != ends[i][1]}
    got = [tuple(r) for r in graph.find_bridges(links, task_links).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert graph.find_bridges(links.limit(0)).collect() == []


def test_infeasible_partitions_say_why(spark):
    segments = spark.createDataFrame([("s1", 4), ("s2", 10), ("s3", 6), ("x", 7)], "segment_id string, ln long")
    backbone = spark.createDataFrame([("c", 0, 4, "s1"), ("c", 4, 14, "s2"), ("d", 0, 6, "s3")], "reference string, start long, end_ long, segment_id string")
    links = spark.createDataFrame([("s1", "s2"), ("s2", "s3")], "left_id string, right_id string")
    bridges = graph.find_bridges(links)
    boundaries, cuts = graph.choose_cuts(backbone, links, bridges, 5, 1)
    assert sorted(map(tuple, boundaries.collect())) == [("c", 5, 4, 1, True, "bridge"), ("c", 10, 4, 6, False, "no_bridge_within_slack"), ("d", 5, None, None, False, "no_bridge_within_slack")]
    chunks = graph.partition_graph(segments, links, backbone, cuts, 9, 8)
    assert sorted(map(tuple, chunks.collect())) == [("s1", "c", 0, 4, 4, 4, 1, "PASS"), ("s2", "c;d", 0, 14, 10, 16, 2, "multiple_references,reference_span_limit,seed_bases_limit"), ("x", ".", 0, 0, 0, 7, 1, "PASS")]
    report = graph.partition_report(chunks, bridges, cuts).first()
    assert (report.feasible, report.problems, report.chunks, report.bridges, report.cuts, report.off_reference_chunks) == (False, 1, 3, 2, 1, 1)
    with pytest.raises(Exception, match="no forward link"):
        graph.choose_cuts(backbone, links.filter("left_id = 's2'"), bridges, 5, 1)


@pytest.mark.parametrize(("parts", "span", "ranges"), [(1, 40_000, 4), (7, 40_000, 25), (5, 4_000, 60), (3, 300, 40), (3, 1, 7)])
def test_clusters_against_brute_force(spark, parts, span, ranges):
    """Sparse and dense rows, the dense ones without any gap, on any partitions; rows that lack a field stay by themselves."""
    random.seed(1)
    data = [("REF", random.choice(["chr1", "chr2"]), random.randrange(span), random.choice(["INS", "DEL"]), random.randrange(50, 300), f"e{i}", random.choice([None, "", "ACGT", "AC"])) for i in range(600)]
    want = plain_greedy(data, 500, 0.7)
    lacking = [(None, "chr1", 5, "INS", 60, "n0", ""), ("REF", None, 5, "INS", 60, "n1", ""), ("REF", "chr1", None, "INS", 60, "n2", ""), ("REF", "chr1", 5, None, 60, "n3", ""), ("REF", "chr1", 5, "INS", None, "n4", "")]
    data += lacking
    random.shuffle(data)
    schema = "frame string, chromosome string, position_0 long, svtype string, svlen long, evidence_id string, alternate_sequence string"
    df = spark.createDataFrame(data, schema).repartition(parts)
    got = catalog.cluster_evidence(df, parts=ranges)
    assert got.columns == [*df.columns, "cluster_head"]
    assert {r.evidence_id: r.cluster_head for r in got.collect()} == want | {r[5]: r[5] for r in lacking}
    assert catalog.cluster_evidence(df.limit(0)).collect() == []
    twice = catalog.cluster_evidence(df.union(df), parts=ranges).groupBy("evidence_id").agg(F.count_distinct("cluster_head").alias("n"), F.max("cluster_head").alias("h"), F.count(F.lit(1)).alias("k")).collect()
    assert all((r.n, r.k) == (1, 2) for r in twice) and {r.evidence_id: r.h for r in twice} == want | {r[5]: r[5] for r in lacking}


def test_a_dense_position_is_many_ranges(spark):
    """All rows in one place of one chromosome: no range holds more than a few times its share."""
    from pyspark.sql import DataFrame

    seen = []
    keep = catalog.saved

    def watched(df: DataFrame) -> DataFrame:
        out = keep(df)
        seen.append(sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()))
        return out

    df = spark.range(4000).selectExpr("'REF' frame", "'chr1' chromosome", "id div 2000 position_0", "'DEL' svtype", "50 + id % 900 svlen", "'e' || id evidence_id")
    catalog.saved = watched
    try:
        assert catalog.cluster_evidence(df, parts=16).count() == 4000
    finally:
        catalog.saved = keep
    assert len(seen[0]) >= 12 and seen[0][-1] <= 3 * 4000 / 16
    numbers = catalog.number_all(df, ["position_0", "svlen", "evidence_id"], "n")
    assert [r.n for r in numbers.orderBy("position_0", "svlen", "evidence_id").collect()] == list(range(1, 4001))


@pytest.mark.parametrize("width", [7, 100, 100_000])
def test_nearest_against_brute_force(spark, width):
    """All ties, over ranges with neither loci nor features between them."""
    random.seed(9)
    loci = [(f"l{i}", c, s, s + random.choice([0, 1, 30])) for i in range(80) for c, s in [(random.choice("ab"), random.randrange(3000))]]
    features = [(f"f{i}", c, s, s + random.randrange(1, 60)) for i in range(40) for c, s in [(random.choice("ac"), random.choice([random.randrange(300), 2500 + random.randrange(300)]))]]
    want = []
    for name, c, lo, hi in loci:
        away = [(max(s - hi, lo - e, 0), f) for f, k, s, e in features if k == c]
        want += [(name, f, d) for d, f in away if d == min(away)[0]]
    a = spark.createDataFrame(loci, "locus_id string, chromosome string, locus_start long, locus_end long")
    b = spark.createDataFrame(features, "feature_id string, chromosome string, start long, end_ long")
    got = intervals.nearest_join(a, b, ["chromosome"], width)
    assert rows(got, "locus_id", "feature_id", "distance") == sorted(want)


def test_components_on_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(3000)] + [(9001, 9000), (9001, 9002)], "a long, b long")
    got = components(edges).groupBy("root").count().collect()
    assert sorted((r.root, r["count"]) for r in got) == [(0, 3001), (9000, 3)]


def test_bridges_against_removal():
    random.seed(3)
    for _ in range(60):
        n = random.randrange(2, 9)
        edges = [(random.randrange(n), random.randrange(n)) for _ in range(random.randrange(1, 12))]
        edges = [e for e in edges if e[0] != e[1]]

        def parts(es):
            p = list(range(n))

            def find(x):
                while p[x] != x:
                    x = p[x]
                return x

            for a, b in es:
                p[find(a)] = find(b)
            return len({find(x) for x in range(n)})

        assert kernels.bridges(edges) == [i for i in range(len(edges)) if parts(edges[:i] + edges[i + 1 :]) > parts(edges)]


def test_statistics_kernels():
    assert kernels.fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert kernels.fisher_two_sided(0, 0, 0, 0) == 1.0
    assert kernels.clopper_pearson(0, 10)[1] == pytest.approx(0.3084971, abs=1e-6)
    assert kernels.clopper_pearson(5, 10) == pytest.approx((0.1870860, 0.8129140), abs=1e-6)
    d = np.array([1.0, 2.0, 3.0])
    want = np.mean([abs(np.dot(s, d)) >= 6 - 1e-9 for s in itertools.product([-1, 1], repeat=3)])
    assert kernels.sign_flip(d, 10, 1) == (want, True)
    assert kernels.sign_flip(np.zeros(0), 10, 1) == (None, True)
    assert kernels.sign_flip(np.zeros(3), 10, 1) == (1.0, True)
    assert not kernels.sign_flip(np.array([0.0, *range(1, 17)]), 10, 1)[1]  # 17 pairs, one of them zero
    x = np.column_stack([np.ones(8), [0, 0, 0, 0, 1, 1, 1, 1]])
    beta, _ = kernels.Firth(x, np.array([0, 0, 0, 0, 1, 1, 1, 1.0])).fit()
    assert np.isfinite(beta).all() and beta[1] == pytest.approx(2 * np.log(9), abs=1e-4)


def test_threshold_boundaries_and_samples(spark):
    limits = {n: v for n, v in zip((c[2] for c in qc.limits_on("total_length_bp", "contig_n50_bp", "n_percent")), (90, 110, 40, 1.0), strict=True)}
    df = spark.createDataFrame([("S1", "hap1", 90, 40, 1.0), ("S1", "hap2", 89, 40, 1.0), ("S2", "hap1", 100, 50, 0.5)], "sample string, haplotype string, total_length_bp long, contig_n50_bp long, n_percent double")
    done = qc.classify_thresholds(df, limits, limits, qc.limits_on("total_length_bp", "contig_n50_bp", "n_percent"))
    assert [r[0] for r in done.select("assembly_status").collect()] == ["PASS", "FAIL", "PASS"]
    assert "total_length_bp>=90 (observed 89.000)" in [r[0] for r in done.select("fail_reasons").collect()]
    got = {r["sample"]: (r.sample_status, r.reasons) for r in qc.sample_decisions(done).collect()}
    assert got["S1"][0] == "PARTIAL" and got["S2"] == ("FAIL", "missing hap2")
    assert {r["sample"]: r.sample_status for r in qc.sample_decisions(done, True).collect()}["S2"] == "PARTIAL"


def test_column_literals(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("c")).first().c
    assert get(C.tags_to_map(F.array(F.lit("a:i:1"), F.lit("b:Z:x:y"), F.lit("a:i:2")))) == {"a": "2", "b": "x:y"}
    assert get(C.normalize_chrom(F.lit("CHM13#0#chrm"), "bare")) == "MT" and get(C.normalize_chrom(F.lit("CHM13.x"), "chr")) == "chrX"
    assert get(C.flip_edge(F.lit(">a<b"))) == ">b<a"
    assert get(C.canonical_traversal(F.lit(">a<b"), F.lit("-"))) == ">b<a"
    assert get(C.reverse_complement(F.lit("ACRN"), True)) == "NYGT"
    assert tuple(get(C.mask_bases(F.lit("WGTCCaTTCG")))) == ("NGTCCATTCG", 1, 1, True)
    assert get(C.infer_svtype(F.lit("A"), F.lit("N]chr2:5]"), F.lit(None).cast("string"))) == "BND"
    assert get(C.infer_svlen(F.lit(101), F.lit("A"), F.lit("<DEL>"), F.lit("-61,-5"), F.lit(None).cast("string"))) == 61
    assert get(C.to_long(F.lit("9007199254740993"))) == 9007199254740993
    assert get(C.first_known(F.lit("NA"), F.lit(" x "))) == "x"
    assert get(C.parse_cigar(F.lit("5M2"))) is None
    diff = get(C.traversal_difference(C.path_tokens(F.lit(">a>b>c")), C.path_tokens(F.lit(">a>x>c"))))
    assert (diff.prefix, diff.suffix, diff.junctions, diff.reference_edges, diff.inserted) == (1, 1, [">a>x", ">x>c"], [">a>b", ">b>c"], [">x"])
    assert get(C.event_discordance(C.parse_cigar(F.lit(None).cast("string")), F.lit(0), F.lit(0), F.lit(5), 3)) == (1 << 63) - 1
    with pytest.raises(Exception, match="flag"):
        get(C.flag(F.lit("maybe")))


def test_fragments_that_conflict_count_for_neither(spark):
    hits = spark.createDataFrame([("f1", "left"), ("f1", "right"), ("f2", "left"), ("f2", "reference"), ("f3", "reference"), ("f1", "left")], "fragment string, feature string").withColumn("k", F.lit("x"))
    got = evidence.fragment_support(hits, ["k"]).first()
    assert (got.left_fragments, got.right_fragments, got.reference_fragments, got.conflicting_fragments) == (1, 1, 1, 1)


def test_molecule_support_and_lock(spark):
    pieces = spark.createDataFrame([("L", "m1", "n", 0, 60), ("L", "m1", "n", 40, 100)], "locus string, molecule_id string, node_id string, start long, end_ long")
    targets = spark.createDataFrame([("L", "n", 0, 100), ("Z", "n", 0, 10)], "locus string, node_id string, start long, end_ long")
    got = {r.locus: (r.molecules, r.depth) for r in evidence.molecule_support(pieces, targets, ["locus"]).collect()}
    assert got == {"L": (1, 1.0), "Z": (0, 0.0)}
    ev = spark.createDataFrame([("g", "l", "a", 3, 3, 0, 10.0, 0.0), ("g", "l", "a", 0, 0, 5, 10.0, 0.0), ("g", "l", "a", 1, 0, 5, 10.0, 0.0), ("g", "q", "a", 9, 9, 0, 10.0, 0.0)], "graph_id string, locus_id string, allele_id string, left_support int, right_support int, reference_support int, depth double, mapping_ambiguity double")
    lock = spark.createDataFrame([("g", "l", "a", "PASS", 2, 2, 5.0, 0.5)], "graph_id string, locus_id string, allele_id string, technical_status string, min_alt int, min_ref int, min_depth double, max_mapping_ambiguity double")
    assert sorted(r.carrier_state for r in evidence.apply_measurement_lock(ev, lock).collect()) == ["ALT_SUPPORTED", "NOT_LOCKED", "NO_CALL", "REF_SUPPORTED"]


@pytest.mark.parametrize("cells", [(1, 9, 6, 14), (5, 5, 5, 5), (0, 8, 7, 9), (12, 3, 2, 20)])
def test_firth_profiles_against_a_plain_search(cells):
    """In a saturated model the penalised likelihood falls apart into cells with a half added, so a profile is a search along one line."""
    a, b, c, d = cells  # carriers with and without the outcome, others with and without it
    y = np.array([1.0] * a + [0.0] * b + [1.0] * c + [0.0] * d)
    carrier = np.array([1.0] * (a + b) + [0.0] * (c + d))
    model = kernels.Firth(np.column_stack([np.ones(len(y)), carrier]), y)
    beta, best = model.fit()
    assert beta[1] == pytest.approx(np.log((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5))), abs=1e-7)

    def profile(at):
        lines = np.linspace(-12, 12, 400_001)
        p0, p1 = 1 / (1 + np.exp(-lines)), 1 / (1 + np.exp(-lines - at))
        return ((c + 0.5) * np.log(p0) + (d + 0.5) * np.log(1 - p0) + (a + 0.5) * np.log(p1) + (b + 0.5) * np.log(1 - p1)).max()

    assert 2 * (best - model.fit(1, 0.0)[1]) == pytest.approx(2 * (profile(beta[1]) - profile(0)), abs=1e-6)
    for end in model.interval(1, beta, best):
        assert 2 * (profile(beta[1]) - profile(end)) == pytest.approx(3.841458820694124, abs=1e-5)


def test_firth_intervals_hold_the_estimate(spark):
    rng = random.Random(2)
    data = [(f"g{g}", int(rng.random() < 0.4), int(rng.random() < 0.5), rng.random()) for g in range(4) for _ in range(30)] + [("gap", 1, 1, None)]
    for r in stats.firth_tests(spark.createDataFrame(data, "k string, y int, c int, z double"), "k", "y", "c", ["z"]).collect():
        assert r.status == "SKIPPED" or r.ci_low < r.odds_ratio < r.ci_high and (r.p_value < 0.05) == (not r.ci_low < 1 < r.ci_high)


def test_coverage_sample(spark):
    reads = spark.createDataFrame([("s1", f"r{i}", 100) for i in range(3000)] + [("s2", f"r{i}", 10) for i in range(50)] + [("s3", "x", 5), ("s3", "x", 5), ("s4", "z", 0), ("s5", None, 9)], "k string, name string, n long")
    chosen, report = cohort.coverage_sample(reads, ["k"], "name", "n", "7", 3.0, 10_000)
    by = {r.k: r for r in report.collect()}
    assert (by["s1"].total_bases, by["s1"].requested_bases, by["s1"].sampling_fraction) == (300_000, 30_000, 0.1) and 200 < by["s1"].selected_reads < 400 and by["s1"].selected_bases == 100 * by["s1"].selected_reads
    assert (by["s2"].sampling_fraction, by["s2"].selected_reads) == (1.0, 50)
    assert {k: by[k].problem for k in ("s1", "s2", "s3", "s4", "s5")} == {"s1": "", "s2": "", "s3": "duplicate read names", "s4": "no bases", "s5": "no reads selected"}
    names = {r.name for r in chosen.filter("k = 's1'").collect()}
    assert names == {f"r{i}" for i in range(3000) if kernels.blake2b_unit("7", f"r{i}") < 0.1}
    assert cohort.coverage_sample(reads, ["k"], "name", "n", "7", None, 1)[0].count() == 3000 + 50 + 2
    with pytest.raises(ValueError, match="positive"):
        cohort.coverage_sample(reads, ["k"], "name", "n", "7", 0, 1)


def test_firth_statuses(spark):
    data = [("a", i % 2, int(i > 4), 1.0 * (i % 3)) for i in range(10)] + [("b", 1, i % 2, 1.0) for i in range(6)]
    got = {r.k: r.status for r in stats.firth_tests(spark.createDataFrame(data, "k string, y int, c int, z double"), "k", "y", "c", ["z"]).collect()}
    assert got == {"a": "ESTIMATED", "b": "SKIPPED"}


def test_hash_sample_is_stable(spark):
    df = spark.range(2000).select(F.concat(F.lit("r"), "id").alias("name"))
    a = {r[0] for r in cohort.hash_sample(df.repartition(3), "name", "s", 0.2).collect()}
    assert a == {r[0] for r in cohort.hash_sample(df.repartition(5), "name", "s", 0.2).collect()} and 300 < len(a) < 500


def test_affine_sample_has_exact_size(spark):
    df = spark.range(1000).withColumnRenamed("id", "i")
    got = cohort.affine_sample(df, "i", 1000, 137, 7919, 55)
    assert got.count() == 137 and got.select("sample_place").distinct().count() == 137


def test_depth_quartiles_by_plain_ranks(spark):
    rng = random.Random(4)
    depth = [rng.choice([None, rng.randrange(12), rng.randrange(400)]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(depth)), "i long, d long").repartition(5)
    got = {r.i: r.q for r in df.withColumn("q", cohort.depth_quartiles(df, "d")).collect()}
    key = lambda d: (d is not None, d or 0)
    assert got == {i: str(-(-4 * (1 + sum(key(x) < key(d) for x in depth)) // 300)) for i, d in enumerate(depth)}
    totals = {r.d: r.t for r in running_totals(df.filter("d is not null").groupBy("d").agg(F.count(F.lit(1)).alias("n")), ["d"], {"t": "n"}).collect()}
    assert totals == {d: sum(x is not None and x <= d for x in depth) for d in depth if d is not None}


@pytest.mark.parametrize("piece", [50, 700, 1 << 22])
@pytest.mark.parametrize("k", [1, 7, 31])
def test_distinct_kmers(spark, monkeypatch, k, piece):
    """Against sets, for names of several rows, odd letters, short and null texts, in pieces and parts of any size."""
    monkeypatch.setattr(evidence, "KMER_BASES", piece)
    rng = random.Random(k)
    data = [(i % 5, "".join(rng.choice("ACGTACGTACGTACGTN-aé") if rng.random() < 0.05 else rng.choice("ACGT") for _ in range(rng.choice([0, 3, 40, 900])))) for i in range(30)]
    data += [(0, data[0][1]), (7, "A" * 500), (8, None), (None, "ACGT"), (9, "N" * 50)]
    want = {}
    for name, text in data:
        if name is not None and text:
            own = {text[i : i + k] for i in range(len(text) - k + 1)}
            want.setdefault(name, set()).update(x for x in own if set(x) <= set("ACGT"))
    got = evidence.distinct_kmers(spark.createDataFrame(data, "name long, seq string").repartition(4), k).collect()
    assert {r.name: r.kmers for r in got} == {n: len(x) for n, x in want.items() if x}
    assert evidence.distinct_kmers(spark.createDataFrame([], "name long, seq string"), k).collect() == []


def test_kmers_are_shuffled_in_less_than_twice_their_bases():
    rng = np.random.default_rng(0)
    text = "".join(rng.choice(list("ACGT"), 200_000))
    for parts in (1, 16, 1024):
        packed = kernels.pack_kmers(text, 31, 11, parts)
        assert sum(len(b) for _, b in packed) < (0.3 if parts == 1 else 1.6) * len(text)
        assert sum(len(kernels.unpack_kmers(b, 31)) for _, b in packed) == len(text) - 30


def test_guards(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="twice"):
        checks.raise_if_any(checks.duplicate_keys(df, ["k"]), "twice")
    parts = checks.check_parts(spark.createDataFrame([("a",), ("b",)], "p string"), spark.createDataFrame([("a", 0), ("c", 3)], "p string, n_rows int"), "p")
    assert rows(parts, "p", "problem") == [("a", "EMPTY"), ("b", "MISSING"), ("c", "UNDECLARED")]


def test_windows_at_block_borders(spark):
    seq = "".join(random.Random(2).choice("ACGT") for _ in range(1000))
    windows = spark.createDataFrame([("w1", "c", 60, 200), ("w2", "c", 950, 1100), ("w3", "c", 128, 256)], "window_id string, contig string, start long, end_ long")
    got = {r.window_id: (r.window_seq, r.truncated) for r in annotate.extract_windows(spark.createDataFrame([("c", seq)], "contig string, seq string"), windows, 64).collect()}
    assert got == {"w1": (seq[60:200], False), "w2": (seq[950:], True), "w3": (seq[128:256], False)}


def test_walks(spark):
    segments = spark.createDataFrame([("a", "AC", 2), ("b", "GG", 2)], "segment_id string, seq string, ln long")
    links = spark.createDataFrame([(">a", ">b")], "left_token string, right_token string")
    walks = spark.createDataFrame([("w", ">a>b"), ("x", ">b>a"), ("y", "<b<a")], "walk_id string, path string")
    got = {r.walk_id: (r.missing_links, r.length) for r in graph.verify_walks(walks, segments, links).collect()}
    assert got == {"w": (0, 4), "x": (1, 4), "y": (0, 4)}
    spelled = {r.walk_id: r.sequence_sha256 for r in graph.verify_walks(walks, segments, links).collect()}
    assert spelled["w"] == hashlib.sha256(b"ACGG").hexdigest() and spelled["y"] == hashlib.sha256(b"CCGT").hexdigest()


def test_repeat_calls(spark):
    rows = [
        ("pass", "chr1", 100, 130, "PASS", "0/1", "10/12", "8-11/12-14", True),
        ("haploid", "chr1", 100, 130, "PASS", "1", "10", "8-11", True),
        ("outside", "chr1", 100, 130, "PASS", "0/1", "10/20", "8-11/12-14", True),
        ("low", "chr1", 100, 130, "q;LowDepth", "0/1", "10/12", "8-11/12-14", True),
        ("none", "chr1", 100, 130, "PASS", "./.", "./.", "./.", True),
        ("null", "chr1", 100, 130, None, None, None, None, True),
        ("filtered", "chr1", 100, 130, "q", "0/1", "10/12", "8-11/12-14", True),
        ("moved", "chr1", 101, 130, "PASS", "0/1", "10/12", "8-11/12-14", True),
        ("unknown", "chr1", 100, 130, "PASS", "0/1", "10/12", "8-11/12-14", False),
    ]
    df = spark.createDataFrame(rows, "id string, chromosome string, pos long, end_ long, filter string, gt string, repcn string, repci string, catalog_found boolean")
    df = df.selectExpr("*", "'chr1' AS catalog_chromosome", "100L AS catalog_start", "130L AS catalog_end")
    got = {r.id: r for r in calls.parse_repeat_calls(df).collect()}
    want = {"pass": "CALLER_PASS", "haploid": "CALLER_PASS", "outside": "PARTIAL_GENOTYPE", "low": "LOW_DEPTH", "none": "NO_CALL", "null": "NO_CALL", "filtered": "FILTERED_OR_UNASSESSED", "moved": "CATALOG_COORDINATE_MISMATCH", "unknown": "NOT_IN_CATALOG"}
    assert {k: r.call_status for k, r in got.items()} == want
    assert (got["pass"].allele2_repeat_units, got["pass"].allele2_ci_low, got["moved"].allele1_repeat_units) == (12, 12, None)


def test_path_coordinates(spark):
    segments = spark.createDataFrame([("a", 100, None, None, False), ("b", 50, "y", None, True), ("c", 70, None, "e3", False)], "segment_id string, ln long, alias string, event_id string, novel boolean")
    events = spark.createDataFrame([("e1", "b", 20), ("e2", "y", 90), ("e3", "zz", 5), ("e4", "a", 30)], "event_id string, graph_segment string, segment_offset long")
    aln = spark.createDataFrame([(1, ">a<b>a"), (2, "a"), (3, ">c>q>b"), (4, None), (5, "y"), (6, "")], "aln_id long, path string")
    got = {(r.aln_id, r.event_id): (r.coordinate, r.alternate) for r in alleles.path_event_coordinate(aln, events, segments).collect()}
    assert got == {(1, "e1"): (120, True), (1, "e2"): (150, True), (1, "e4"): (30, True), (2, "e4"): (30, False), (3, "e1"): (90, True), (3, "e2"): (120, True), (3, "e3"): (None, True), (5, "e2"): (90, False)}


def test_reconstructed_alleles(spark):
    left, right = "ACCTGAAGCT", "GGATCTTACC"
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reference = spark.createDataFrame([("r", left + right)], "contig string, seq string")
    plus, pal = left + "TTTAC" + right, left + "ACGT" + right
    sources = spark.createDataFrame([("p", plus), ("m", turned(plus)), ("q", pal), ("x", left + "TTTAC" + right[::-1])], "contig string, seq string")
    rows = [("plus", "r", 10, "p", 10, "TTTAC"), ("minus", "r", 10, "m", 10, "TTTAC"), ("pal", "r", 10, "q", 10, "ACGT"), ("reviewed", "r", 10, "q", 10, "ACGT"), ("flanks", "r", 10, "x", 10, "TTTAC"), ("other", "r", 10, "p", 10, "CCCCC"), ("edge", "r", 4, "p", 10, "TTTAC"), ("lost", "r", 10, "none", 10, "TTTAC")]
    candidates = spark.createDataFrame(rows, "candidate_id string, chromosome string, position long, source_contig string, source_offset long, allele string")
    review = spark.createDataFrame([("reviewed", "+")], "candidate_id string, orientation string")
    built = alleles.reconstruct_alleles(candidates, reference, sources, review, 10)
    got = {r.candidate_id: (r.status, r.source_orientation, r.alternate_seq) for r in built.collect()}
    assert got["plus"] == ("PASS", "+", plus) and got["minus"] == ("PASS", "-", plus) and got["reviewed"] == ("PASS", "+", pal)
    assert got["flanks"][0] == "SOURCE_INSERT_CONFIRMED_ANCHORS_PENDING"
    assert {k for k, v in got.items() if v == ("REJECTED", None, None)} == {"pal", "other", "edge", "lost"}
    found = {r.candidate_ids for r in alleles.distinct_alleles(built).collect()}
    assert found == {"flanks;minus;plus", "reviewed"}


def test_crosswalk_agrees(spark):
    contigs = spark.createDataFrame([("A1", "c1", "h1 x", "S#1#c1", 10), ("A1", "c2", "h2", "S#1#c2", 5)], "assembly_id string, contig_id string, original_header string, panel_name string, length long")
    manifest = spark.createDataFrame([("A1", "S", "1", 2, 15)], "assembly_id string, sample string, haplotype string, contig_count long, total_bases long")
    assert checks.check_crosswalk(contigs, manifest).count() == 0
    again = checks.check_crosswalk(contigs.unionByName(contigs.limit(1)), manifest)
    assert {r.check for r in again.collect()} == {"contig_count", "total_bases", "query_name", "original_name", "panel_name"}
    assert checks.check_crosswalk(contigs.limit(0), manifest.limit(0)).count() == 0


def test_panel_scan_against_plain_counts():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ACGTN"), rng.integers(0, 200))) for _ in range(60)] + ["", "AC", "é" * 10]
    panel = [("ACG", "p"), ("NTA", "p"), ("ACG", "q"), ("GGT", "q"), ("ééé", "r")]
    row, group, n = kernels.PanelScan([k for k, _ in panel], [g for _, g in panel], 3).count(texts, chunk=17)
    want = {}
    for i, t in enumerate(texts):
        for k, g in panel:
            c = sum(t[j : j + 3] == k for j in range(len(t) - 2))
            if c:
                want[i, g] = want.get((i, g), 0) + c
    assert dict(zip(zip(row.tolist(), group, strict=True), n.tolist(), strict=True)) == want
    assert kernels.PanelScan([], [], 3).count(texts)[1] == []


def test_one_pass_unions_against_bases(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), int(s), int(s + n), bool(f)) for k, s, n, f in zip(rng.integers(0, 3, 90), rng.integers(0, 300, 90), rng.integers(0, 25, 90), rng.random(90) < 0.5, strict=True)]
    df = spark.createDataFrame(rows, "k int, start int, end_ int, f boolean")
    got = intervals.union_lengths(df, ["k"], {"yes": F.col("f"), "no": ~F.col("f"), "all": F.lit(True)}, largest={"longest": "yes"}).collect()
    for r in got:
        base = {n: {b for k, s, e, f in rows if k == r.k and keep(f) for b in range(s, e)} for n, keep in (("yes", lambda f: f), ("no", lambda f: not f), ("all", lambda f: True))}
        assert (r.yes, r.no, r.all) == tuple(len(base[n]) for n in ("yes", "no", "all"))
        runs, at = [0], None
        for b in sorted(base["yes"]):
            runs.append(runs[-1] + 1 if b - 1 == at else 1)
            at = b
        assert r.longest == max(runs)


def test_catalogue_rows_are_shuffled_once(spark):
    """Before the ordinals, evidence rows move once, by cluster, and a row is never multiplied by its lists; rows without a chromosome stay."""
    data = [("REF", "chr1", 5, "INS", 60, f"e{i}", "h0", f"S{i % 3}", f"S{i % 3}.hap1", "graph_residual", "graph", False, "REVIEW", "primary") for i in range(30)]
    data += [("REF", None, 5, "INS", 60, "n1", "n1", "S1", "S1.hap1", "graph_residual", "graph", False, "REVIEW", "primary")]
    df = spark.createDataFrame(data, "frame string, chromosome string, position_0 long, svtype string, svlen long, evidence_id string, cluster_head string, sample_id string, assembly_id string, discovery_method string, caller string, graph_member boolean, confidence_tier string, qc_tier string")
    plans, keep = [], catalog.saved
    catalog.saved = lambda d: plans.append(d._jdf.queryExecution().sparkPlan().toString()) or keep(d)
    try:
        got = catalog.catalog_rows(df).orderBy("ordinal").collect()
    finally:
        catalog.saved = keep
    assert [(r.chromosome, r.evidence_count, r.carrier_samples) for r in got] == [(None, 1, "S1"), ("chr1", 30, "S0;S1;S2")]
    assert got[1].evidence_ids == ";".join(sorted(f"e{i}" for i in range(30)))
    assert "Generate" not in plans[0] and "Join" not in plans[0]


@pytest.mark.parametrize("width", [3, 50, 100_000])
def test_bubbles_against_brute_force(spark, width):
    """Repeated bubble ids and events, negative places, rows without a place; pairs are made for repeated events only."""
    from cohortspan.operators import compare

    rng = random.Random(width)
    plans = [(f"e{i % 70}" if i % 9 == 0 else f"u{i}", rng.choice("abc"), rng.choice([None, *range(0, 300, 7)])) for i in range(150)] + [("z", None, 5)]
    bubbles = [(f"b{i % 50}", rng.choice("ab"), s, s + rng.randrange(60)) for i in range(80) for s in [rng.randrange(-20, 280)]] + [("x", "a", None, 40), (None, "a", 3, 4)]
    near = {}
    for e, c, p in plans:
        near.setdefault(e, set()).update(b for b, k, s, t in bubbles if b and p is not None and k == c and any(x is not None and abs(p - x) <= 12 for x in (s, t)))
    a = spark.createDataFrame(plans, "event_id string, chromosome string, position_0 long")
    b = spark.createDataFrame(bubbles, "bubble_id string, chromosome string, start long, end_ long")
    got = compare.bubble_match(a, b, 12, width)
    assert rows(got, "event_id", "bubbles") == sorted((e, len(near[e])) for e, _, _ in plans)
    assert "_open" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("width", "most"), [(10, 2), (64, 5), (5_000, 4096)])
def test_annotation_context_against_brute_force(spark, width, most):
    """Loci over several bins, bins of several rows, repeated ids; (locus, feature) pairs are never grouped."""
    from cohortspan.operators import annotate

    rng = random.Random(most)
    loci = [(f"l{i}", rng.choice(["c1", "c2", None]), s, s + rng.choice([0, 1, 9, 80])) for i in range(120) for s in [rng.randrange(600)]] + [("l0", "c1", 30, 60)]
    features = [(f"f{i % 90}", rng.choice(["c1", "c2"]), s, s + rng.randrange(0, 90), rng.choice(["gene", "exon", "repeat", "tss"])) for i in range(140) for s in [rng.randrange(600)]]
    hit = {}
    for name, c, lo, hi in loci:
        for f, k, s, e, kind in features:
            if k == c and lo < e and s < hi:
                hit.setdefault((name, kind), set()).add(f)
    shown = lambda name, kind: ";".join(sorted(hit.get((name, kind), ()))) or "NO_OVERLAP"
    want = [(n, shown(n, "gene"), shown(n, "exon"), "EXONIC" if (n, "exon") in hit else "GENIC" if (n, "gene") in hit else "INTERGENIC") for n, *_ in loci]
    a = spark.createDataFrame(loci, "locus_id string, chromosome string, locus_start long, locus_end long")
    b = spark.createDataFrame(features, "feature_id string, chromosome string, start long, end_ long, feature_type string")
    assert rows(annotate.annotation_context(a, b, ["gene", "exon"], width, most), "locus_id", "gene", "exon", "gene_context") == sorted(want)


def test_bed_context_meets_a_label_once(spark):
    """A thousand intervals of a label around a point are one; padding is cut at zero."""
    points = spark.createDataFrame([("p", "c1", 500), ("q", "c1", 0), ("r", "c1", 9_000), ("s", "c2", 5)], "locus_id string, chromosome string, position_0 long")
    beds = spark.range(1000).selectExpr("'c1' chromosome", "400 + id % 90 start", "450 + id % 90 end_", "'x' label").union(spark.sql("select 'c1', 0L, 0L, 'none'")).union(spark.sql("select 'c1', 1L, 2L, 'y'"))
    pairs, keep = [], intervals.overlap_join
    intervals.overlap_join = lambda *a, **k: pairs.append(keep(*a, **k)) or pairs[-1]
    try:
        got = intervals.bed_context(points, beds, 300)
    finally:
        intervals.overlap_join = keep
    assert rows(got, "locus_id", "context") == [("p", "x"), ("q", "y"), ("r", "NO_OVERLAP"), ("s", "CONTIG_NOT_IN_BED")]
    assert pairs[0].count() == 2


def test_affine_sample_sql_finds_any_inverse():
    """The SQL's inverse of the multiplier, where it lies beyond 200,000."""
    import duckdb

    from cohortspan.plans import all_queries

    con = duckdb.connect()
    con.execute("create view events as select i as event_id, i as user_id from range(600000) r(i)")
    got = con.execute(all_queries()[1]["smp_2_affine_sample"]).fetchall()
    inverse = pow(7919, -1, 600_000)
    assert inverse > 200_000 and sorted(got) == sorted((i, (i - 12345) * inverse % 600_000) for i in range(600_000) if (i - 12345) * inverse % 600_000 < 500)


def test_transitive_edges_grow_with_the_nodes(spark):
    """A dense place with and without sequences: a few edges for each node, not one for each pair."""
    nodes = spark.range(3000).selectExpr("id", "'c' chromosome", "'INS' svtype", "id % 500 position_0", "100 + id div 500 * 7 len", "element_at(array('', 'ACGTACGT', 'ACGTACGA'), int(1 + id % 3)) seq", "'e' || id min_id", "'e' || id max_id")
    edges = catalog.transitive_links(nodes, 500, 0.7, 0.8)
    assert edges.count() < 4 * 3000
    assert components(edges).select("root").distinct().count() == 1


@pytest.mark.parametrize(("nodes", "span"), [(1, 3_000), (15, 20_000), (40, 2_000)])
def test_transitive_clusters_over_many_ranges(spark, monkeypatch, nodes, span):
    """Chains across borders of ranges, with a bin's nodes beyond a range too; only what is at borders is put together by rounds."""
    monkeypatch.setattr(catalog, "TASK_NODES", nodes)
    sent, plain = [], catalog.components
    monkeypatch.setattr(catalog, "components", lambda e, *a: sent.append(e.count()) or plain(e, *a))
    rng = random.Random(nodes)
    data = [(f"e{i}", "c1", rng.randrange(span), "INS", rng.choice([0, 50, 60, 85, 121, 173, rng.randrange(40, 900)]), rng.choice(["", "", "ACGTACGTACGT", "ACGTACGTACGA", "TTTTTTTT"])) for i in range(250)]
    df = spark.createDataFrame(data, "event_id string, chromosome string, position_0 long, svtype string, svlen long, alternate_sequence string")
    assert {r.event_id: r.cluster_id for r in catalog.cluster_transitive(df).collect()} == plain_chains(data, 500, 0.7, 0.8)
    bare = df.withColumn("alternate_sequence", F.lit(""))
    monkeypatch.setattr(catalog, "TASK_NODES", 1000)
    catalog.cluster_transitive(bare).collect()
    assert sent[0] > 0 and sent[1] == 0  # one range has no border


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_near_clusters_against_all_pairs(block):
    rng = np.random.default_rng(12)
    for span, distance, similarity in ((4000, 500, 0.7), (200, 7, 0.9), (30, 0, 1.0), (3000, 100, 0.0)):
        p, n, q = rng.integers(-span, span, 120), rng.integers(0, 400, 120), rng.choice([0, 0, 1, 2, 5], 120)
        band = np.zeros(120, int) if similarity <= 0 else n if similarity >= 1 else np.where(n > 0, np.floor(np.log(np.maximum(n, 1)) / -np.log(similarity)), -2).astype(int)
        got = kernels.near_clusters(p, n, q, p // max(distance, 1), band, distance, similarity, block)
        want = np.arange(120)
        ratio = np.minimum.outer(n, n) / np.maximum(np.maximum.outer(n, n), 1)
        ratio[np.maximum.outer(n, n) == 0] = 1
        like = (np.abs(np.subtract.outer(p, p)) <= distance) & (ratio >= similarity) & ((q[:, None] == q) | (q[:, None] == 0) | (q == 0))
        for _ in range(120):
            want = np.where(like, want, 120).min(axis=1)
        assert ((got[:, None] == got) == (want[:, None] == want)).all()
    assert len(kernels.near_clusters(*[np.zeros(0, int)] * 5, 500, 0.7)) == 0


def test_annotation_lists_lie_in_order_of_place(spark):
    """Loci of at most a bin's width find features beyond its border in the one bin where they start; neighbours are written side by side."""
    loci = spark.range(300).selectExpr("'l' || id locus_id", "'c' chromosome", "(id * 37) % 1000 locus_start", "(id * 37) % 1000 + id % 65 locus_end")
    features = spark.range(80).selectExpr("'f' || id feature_id", "'c' chromosome", "(id * 53) % 1000 start", "(id * 53) % 1000 + 1 + id % 90 end_", "'gene' feature_type")
    got = annotate.annotation_context(loci, features, ["gene"], 64)
    place = {r.locus_id: r.locus_start for r in loci.collect()}
    starts = [[place[r.locus_id] for r in part] for part in got.rdd.glom().collect()]
    assert sum(a > b for part in starts for a, b in itertools.pairwise(part)) < 8
    want = {(a.locus_id, f.feature_id) for a in loci.collect() for f in features.collect() if f.start < a.locus_end and a.locus_start < f.end_}
    assert {(r.locus_id, f) for r in got.collect() for f in r.gene.split(";") if f != "NO_OVERLAP"} == want


def test_catalogue_shuffles_sets_and_moves_a_column_once(spark, monkeypatch):
    """Evidence goes to its range without copies of its own columns; a cluster's sets are gathered there before they are shuffled."""
    kept, saved = [], catalog.saved
    monkeypatch.setattr(catalog, "saved", lambda df: kept.append(df) or saved(df))
    rows_ = [("REF", "c1", i % 3, "DEL", 100, f"e{i}", f"s{i % 2}", f"a{i % 2}", "graph_residual", False, "HIGH_CONFIDENCE", "", "x") for i in range(60)]
    df = spark.createDataFrame(rows_, "frame string, chromosome string, position_0 long, svtype string, svlen int, evidence_id string, sample_id string, assembly_id string, discovery_method string, graph_member boolean, confidence_tier string, qc_tier string, caller string")
    got = catalog.catalog_rows(catalog.cluster_evidence(df, parts=2))
    assert sorted(kept[0].columns) == sorted([*df.columns, "_svlen", "_digest"])
    assert not re.search("(?i)repartition|exchange", kept[1]._jdf.queryExecution().analyzed().toString().split("Aggregate")[1].split("MapInArrow")[0])
    r = got.first()
    assert got.count() == 1 and r.carrier_samples == "s0;s1" and r.evidence_count == 60 and r.evidence_ids.split(";") == sorted(f"e{i}" for i in range(60))


def test_tags_are_split_once_a_row(spark):
    tags = F.array(F.lit("a:i:1"), F.lit("b:Z:x:y"), F.lit(None).cast("string"), F.lit(":i:3"), F.lit("c::4"), F.lit("d:i"), F.lit("a:i:2"), F.lit("e:Z:"))
    df = spark.range(1).select(C.tags_to_map(tags).alias("m"), C.tags_to_map(F.lit(None).cast("array<string>")).alias("none"))
    assert df._jdf.queryExecution().analyzed().toString().count("split(") == 2  # one for each call
    assert df.first().asDict() == {"m": {"b": "x:y", "a": "2", "e": ""}, "none": None}


def test_multiset_delta_counts_equal_records(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_REPEATS", 4, raising=False)
    old = spark.createDataFrame([("a", 1)] * 12 + [("b", 2)] * 2 + [("c", None)] * 3, "k string, n long")
    new = spark.createDataFrame([("a", 1)] * 3 + [("b", 2)] * 11 + [("c", None)] * 2 + [("d", 4)], "k string, n long")
    delta = catalog.multiset_delta(old, new, ["k", "n"])
    assert "row_number" not in delta._jdf.queryExecution().analyzed().toString()  # no key is ordered in one task
    got = [tuple(r) for r in delta.groupBy("k", "n", "change").count().collect()]
    assert sorted(got, key=str) == sorted([("a", 1, "MISSING", 9), ("b", 2, "NEW", 9), ("c", None, "MISSING", 3), ("c", None, "NEW", 2), ("d", 4, "NEW", 1)], key=str)


def test_a_range_of_links_is_small_in_python():
    import tracemalloc

    edges = [(f"s{i}|right|s{i + 1}|left", f"s{i}", f"s{i + 1}") for i in range(graph.TASK_LINKS)]
    tracemalloc.start()
    sure, rest = kernels.contract(edges, set(), "0.0")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sure) == graph.TASK_LINKS and not rest
    assert peak < 64 << 20


def test_path_events_walk_each_distinct_path_once(spark, monkeypatch):
    aln = spark.createDataFrame([(i, ">a>b" if i % 2 else "<b") for i in range(40)] + [(90, ""), (91, None)], "aln_id long, path string")
    events = spark.createDataFrame([("e1", "b", 3), ("e2", "a", 9)], "event_id string, graph_segment string, segment_offset long")
    segments = spark.createDataFrame([("a", 5, None, None, False), ("b", 7, None, "e2", True)], "segment_id string, ln long, alias string, event_id string, novel boolean")
    walked, plain = [], alleles._steps
    monkeypatch.setattr(alleles, "_steps", lambda a, s: walked.append(a.count()) or plain(a, s))
    got = rows(alleles.path_event_coordinate(aln, events, segments), "aln_id", "event_id", "coordinate", "alternate")
    assert walked == [2]
    assert got == sorted([(i, "e1", 8, True) for i in range(1, 40, 2)] + [(i, "e2", 5, True) for i in range(1, 40, 2)] + [(i, "e1", 3, True) for i in range(0, 40, 2)] + [(i, "e2", None, True) for i in range(0, 40, 2)])


def test_windows_compute_a_derived_sequence_once(spark):
    contigs = spark.createDataFrame([(1, "acgtn" * 30), (2, ""), (3, None)], "contig long, raw string").select("contig", F.regexp_replace("raw", "n", "N").alias("seq"))
    windows = spark.createDataFrame([("w", 1, 8, 23), ("past", 1, 145, 160), ("none", 2, 0, 4), ("null", 3, 0, 4)], "window_id string, contig long, start long, end_ long")
    found = annotate.extract_windows(contigs, windows, block=10)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
    text = "acgtN" * 30
    assert rows(found, "window_id", "window_seq", "truncated") == sorted([("w", text[8:23], False), ("past", text[145:], True), ("none", "", True), ("null", "", True)])

def test_best_source_without_pairs(spark):
    """Counts and choices equal those of all pairs, with missing, zero and negative lengths, shared ids and places; pairs are never made."""
    n, r = 400, random.Random(5)
    kinds = "event_id string, frame string, chromosome string, svtype string, position_0 long, svlen long, confidence_tier string"

    def rows(mark):
        return [
            (
                r.choice([None, *(f"{mark}{i}" for i in range(n))]) if r.random() < 0.9 else f"{mark}{r.randrange(9)}", r.choice("GR"), r.choice(["chr1", None] + ["chr2"] * 8), "INS",
                r.choice([None, r.randrange(-40, 4000), r.randrange(2400, 2600), 2500]), r.choice([None, 0, -r.randrange(1, 60), *(r.randrange(1, 90) for _ in range(6))]), r.choice(["HIGH_CONFIDENCE", "REVIEW", "REVIEW", None]),
            )
            for _ in range(n)
        ]

    events, sources = spark.createDataFrame(rows("e"), kinds).drop("confidence_tier"), spark.createDataFrame(rows("s"), kinds).withColumnRenamed("event_id", "evidence_id")
    for distance in (50, 3):
        got = catalog.choose_sources(events, sources, distance).collect()
        other = sources.select("frame", "chromosome", "svtype", *(F.col(c).alias(f"other_{c}") for c in ("position_0", "svlen", "evidence_id", "confidence_tier")))
        order = [F.col("other_confidence_tier") != "HIGH_CONFIDENCE", F.abs(F.col("position_0") - F.col("other_position_0")), F.abs(F.col("svlen") - F.col("other_svlen")), F.col("other_evidence_id")]
        pairs = intervals.sv_match(events, other, distance).withColumn("_key", F.struct(*order))
        want = {x["event_id"]: (x["n"], x["k"]) for x in pairs.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("k")).collect()}
        assert len(want) > 100 and {x["event_id"]: x["sources"] for x in got} == {e: n for e, (n, _) in want.items()}
        keys = {(x["event_id"], x["other_evidence_id"], x["other_position_0"], x["other_svlen"]): x["_key"] for x in pairs.collect() if x["_key"] == want[x["event_id"]][1]}
        assert all((x["event_id"], x["other_evidence_id"], x["other_position_0"], x["other_svlen"]) in keys for x in got)
    # 40,000 rows near each other on both sides are 1,600,000,000 pairs
    dense = spark.range(40_000).select(F.concat(F.lit("x"), "id").alias("event_id"), F.lit("G").alias("frame"), F.lit("chr1").alias("chromosome"), F.lit("INS").alias("svtype"), (F.col("id") % 500).alias("position_0"), F.lit(50).cast("long").alias("svlen"), F.lit("REVIEW").alias("confidence_tier"))
    got = catalog.choose_sources(dense.drop("confidence_tier"), dense.withColumnRenamed("event_id", "evidence_id"))
    assert got.agg(F.count(F.lit(1)), F.min("sources"), F.max("sources")).first()[:] == (40_000, 40_000, 40_000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "abs(" not in plan


def test_clusters_are_neither_joined_nor_told_apart_again(spark):
    df = spark.range(3000).selectExpr("'REF' frame", "'chr1' chromosome", "id % 700 position_0", "'DEL' svtype", "50 + id % 90 svlen", "'e' || id evidence_id", "id extra")
    got = catalog.cluster_evidence(df, parts=6)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    data = [(*r[:6], "") for r in df.collect()]
    assert {r.evidence_id: r.cluster_head for r in got.collect()} == plain_greedy(data, 500, 0.7)


@pytest.mark.parametrize("thin", [0, 8, 1000])
def test_heads_of_blocks_are_those_of_single_rows(thin, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(kernels.OpenHeads, "BLOCK", 16)
    monkeypatch.setattr(kernels.OpenHeads, "THIN", thin)
    r = random.Random(thin)
    for span in (1, 20, 300, 3000):
        data = sorted((r.randrange(span), r.choice([0, r.randrange(1, 300)]), f"e{i:03}", r.choice(["", "A", "B"])) for i in range(200))
        one, many = kernels.OpenHeads(50, 0.7), kernels.OpenHeads(50, 0.7)
        want = [one.head(p, n, q, name) for p, n, name, q in data]
        columns = [pa.array(c, t) for c, t in zip(zip(*data, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
        got = [x for cut in (slice(0, 77), slice(77, 200)) for x in many.heads_of(*(c[cut] for c in columns)).to_pylist()]
        assert got == want and many.heads == one.heads


def test_long_read_metrics_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "READ_ROWS", 40, raising=False)
    monkeypatch.setattr(A, "UNION_BASES", 100, raising=False)
    r = random.Random(3)
    data = [(r.choice("ab"), r.randrange(40), *(lambda s: (s, s + r.randrange(0, 250)))(r.randrange(600)), r.randrange(60), r.random() < 0.3) for _ in range(400)]
    data += [("a", 99, None, None, 3, False), ("b", 98, 5, 90, 4, True), ("b", 97, 5, 90, 4, None), ("c", 1, 0, 9, 1, True)]
    df = spark.createDataFrame(data, "assembly_id string, read_name long, qstart long, qend long, mapq long, is_secondary boolean")
    got_df = A.mapping_metrics_long(df, ["assembly_id"])
    plan = got_df._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and ", 11" in plan  # 404 rows
    got = {x.assembly_id: (x.mapped_reads, x.split_reads, x.multimapped_reads, x.aligned_bp) for x in got_df.collect()}
    want = {}
    for name in "abc":
        reads = {}
        for a, read, s, e, _, secondary in data:
            if a == name:
                reads.setdefault(read, []).append((s, e, secondary))
        first = [[x for x in rows if x[2] is False] for rows in reads.values()]
        bases = sum(len(set().union(*(range(s, e) for s, e, _ in rows if s is not None))) for rows in first)
        want[name] = (sum(bool(x) for x in first), sum(len(x) > 1 for x in first), sum(any(x[2] for x in rows) for rows in reads.values()), bases if any(first) else None)
    assert got == want
