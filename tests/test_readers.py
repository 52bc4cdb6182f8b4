import gzip

import pytest
from pyspark.sql import functions as F

from cohortspan.operators import evidence, graph
from cohortspan.sources import readers as R


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_table(spark, tmp_path):
    path = put(tmp_path, "a.tsv", "id\tx\nA\t1\nB\t\n")
    assert [tuple(r) for r in R.read_table(spark, path, required=["id"]).collect()] == [("A", "1"), ("B", None)]
    with pytest.raises(ValueError, match="missing"):
        R.read_table(spark, path, required=["y"])
    with pytest.raises(ValueError, match="repeated"):
        R.read_table(spark, put(tmp_path, "b.csv", "id,id\n1,2\n"))


PAF = "q1\t100\t0\t90\t+\tt1\t1000\t10\t100\t85\t90\t60\ttp:A:P\tcg:Z:90M\tds:Z:a:b\n"


def test_paf(spark, tmp_path):
    path = put(tmp_path, "a.paf", PAF + "short\t1\n")
    rows = R.read_paf(spark, path, "permissive").collect()
    assert len(rows) == 1 and rows[0].matches == 85 and rows[0].tags["ds"] == "a:b" and rows[0].cigar == "90M" and not rows[0].is_secondary
    with pytest.raises(Exception, match="fewer than 12"):
        R.read_paf(spark, path).collect()


def test_gaf_flags_malformed(spark, tmp_path):
    good = "r1/1\t100\t0\t90\t+\t>s1>s2\t1000\t10\t100\t85\t90\t60\ttp:A:S\n"
    bad = good.replace("\t90\t+", "\t190\t+") + "x\ty\n" + good.replace("\t60\t", "\tq\t")
    rows = R.read_gaf(spark, put(tmp_path, "a.gaf", good + bad)).collect()
    assert [r.malformed for r in rows] == [False, True, True, True] and rows[0].is_secondary


def test_gfa(spark, tmp_path):
    path = put(tmp_path, "g.gfa", "H\tVN:Z:1\nS\ts1\tACGTACGTACGT\tSN:Z:chr1\tSO:i:0\tSR:i:0\nS\ts2\t*\tLN:i:7\tSN:Z:d\tSO:i:5\tSR:i:1\nL\ts1\t+\ts2\t+\t0M\nW\tx\t0\tc\t0\t12\t>s1\n")
    segments, links, walks = R.read_gfa(spark, path)
    assert {r.segment_id: (r.ln, r.sn, r.sr) for r in segments.collect()} == {"s1": (12, "chr1", 0), "s2": (7, "d", 1)}
    assert links.count() == 1 and walks.count() == 1


def test_fasta_and_sink(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">c1 first one\nACGT\nNNAC\n>c2\nGG\n")
    df = R.read_fasta(spark, path)
    assert {r.contig: (r.seq, r.description, r.n_count) for r in df.collect()} == {"c1": ("ACGTNNAC", "first one", 2), "c2": ("GG", "", 0)}
    R.write_fasta(df.coalesce(1), str(tmp_path / "out"), wrap=4, prefix="p_")
    text = "".join(r.value + "\n" for r in spark.read.text(str(tmp_path / "out")).collect())
    assert ">p_c1\nACGT\nNNAC\n" in text and ">p_c2\nGG\n" in text


def test_fastq(spark, tmp_path):
    text = "@r1/1\nACGT\n+\nIIII\n@r2/1\nGG\n+\nII\n"
    path = put(tmp_path, "a.fastq", text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    assert [(r.idx, r.name, r.seq) for r in R.read_fastq(spark, path).orderBy("idx").collect()] == [(0, "r1/1", "ACGT"), (1, "r2/1", "GG")]
    assert R.read_fastq(spark, str(tmp_path / "b.fastq.gz")).count() == 2
    with pytest.raises(Exception, match="truncated"):
        R.read_fastq(spark, put(tmp_path, "c.fastq", "@r\nA\n+\n")).collect()


def test_vcf(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n"
    path = put(tmp_path, "a.vcf", head + "chr1\t102\tx\tA\t<DEL>,T\t.\tPASS\tSVTYPE=DEL;SVLEN=-61;IMPRECISE\tGT:CN:NP\t0/1:1\n")
    site = R.read_vcf(spark, path).first()
    assert (site.pos0, site.alts, site.info["SVLEN"], site.info["IMPRECISE"]) == (101, ["<DEL>", "T"], "-61", None)
    call = R.read_sample_vcf(spark, path).first()
    assert call["sample"] == "S1" and call.call == {"GT": "0/1", "CN": "1", "NP": None}
    assert R.inventory_sample_vcfs(spark, {"a": path}).first().files == 1


def test_taxon_report_inherits(spark, tmp_path):
    lines = ["90.0\t9\t0\tR\t1\troot", "50.0\t5\t1\tD\t2\t  Bacteria", "40.0\t4\t4\tS\t562\t    E. coli", "30.0\t3\t1\tD\t2759\t  Eukaryota", "20.0\t2\t2\tS\t9606\t    Homo sapiens", "10.0\t1\t1\tD\t10239\t  Viruses"]
    report = R.read_taxon_report(spark, put(tmp_path, "r.txt", "\n".join(lines) + "\n"))
    got = {r.taxid: r.taxon_group for r in R.inherit_group(report, {2: "bacteria", 10239: "viruses"}, max_depth=4).collect()}
    assert got == {1: None, 2: "bacteria", 562: "bacteria", 2759: None, 9606: None, 10239: "viruses"}
    with pytest.raises(Exception, match="6 or 8"):
        R.read_taxon_report(spark, put(tmp_path, "bad.txt", "1\t2\t3\t4\t5\t6\t7\n")).collect()


def test_bed_and_small_metric_files(spark, tmp_path):
    bed = R.read_bed(spark, put(tmp_path, "a.bed", "track x\n#c\nchr1\t5\t9\tn\n"))
    assert bed.collect() == [("chr1", 5, 9, "n")]
    with pytest.raises(Exception, match="bad BED"):
        R.read_bed(spark, put(tmp_path, "b.bed", "chr1\t9\t9\n")).collect()
    stats = R.read_seq_stats(spark, put(tmp_path, "s.tsv", "file\tnum_seqs\tsum_len\tN50\tmax_len\tGC(%)\tsum_n\nx\t1,000\t2,500\t40\t90\t41.5\t3\n")).first()
    assert (stats.contig_count, stats.total_length_bp, stats.gc_percent) == (1000.0, 2500.0, 41.5)
    flag = R.read_flagstat(spark, put(tmp_path, "f.txt", "100 + 0 in total\n5 + 0 secondary\n90 + 0 mapped (90%)\n80 + 0 properly paired (80%)\n")).first()
    assert (flag.total, flag.secondary, flag.mapped, flag.properly_paired) == (100, 5, 90, 80)


def test_repeat_catalog(spark):
    text = spark.createDataFrame([('{"LocusId":"A","ReferenceRegion":["chr1:5-9","chr1:20-30"],"VariantType":["Repeat","Repeat"]}',), ('{"LocusId":"B","ReferenceRegion":"chr2:1-4","VariantType":"Repeat"}',)], "value string")
    rows = R.select_repeat_catalog(text, spark.createDataFrame([("A",), ("B",), ("C",)], "locus_id string")).collect()
    assert sorted((r.locus_id, r.start, r.catalog_status) for r in rows if r.start) == [("A", 5, "FOUND"), ("A", 20, "FOUND"), ("B", 1, "FOUND")]
    assert [r.locus_id for r in rows if r.catalog_status == "NOT_IN_CATALOG"] == ["C"]


def test_nested_alignments_anchor_edges(spark, tmp_path):
    def node(i, length, seq=None):
        return f'{{"position":{{"node_id":"{i}"}},"edit":[{{"from_length":{length},"to_length":{length}{"" if seq is None else ", " + chr(34) + "sequence" + chr(34) + ":" + chr(34) + seq + chr(34)}}}]}}'

    line = f'{{"name":"r1","mapping_quality":60,"path":{{"mapping":[{node(1, 20)},{node(2, 20)},{node(3, 5, "ACGTA")},{node(4, 20)}]}}}}'
    aln = R.read_alignment_json(spark, put(tmp_path, "a.json", line + "\n"))
    got = evidence.anchored_edges(R.alignment_edits(aln), anchor=10).collect()
    assert [(r.edge_from, r.edge_to) for r in got] == [(">1", ">2")]


def test_unions(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert R.union_tables([a, b], strict=False).count() == 2
    with pytest.raises(ValueError):
        R.union_tables([a, b])


def test_contig_map(spark):
    rows = spark.createDataFrame([("S", 1, "S#1#chr1 note"), ("S", 2, "a:b"), ("S", 2, "c:5-9")], "sample string, hap int, header string")
    assert [r.contig for r in R.contig_map(rows).collect()] == ["chr1", "a_b", "c:5-9"]


def test_locate_on_path_literals(spark):
    segments = spark.createDataFrame([("s1", 100), ("s2", 50)], "segment_id string, ln long")
    events = spark.createDataFrame([("a", ">s1<s2", 25), ("b", ">s1<s2", 110), ("c", ">s9>s1", 5), ("d", ">s1", 100), ("e", ">chr1:1000-1100<donor:2000-2050", 110)], "event_id string, path string, position long")
    got = {r.event_id: (r.segment, r.segment_offset) for r in graph.locate_on_path(events, segments).collect()}
    assert got == {"a": ("s1", 25), "b": ("s2", 39), "c": (None, None), "d": ("s1", 100), "e": ("donor", 2039)}


def test_write_table(spark, tmp_path):
    R.write_table(spark.createDataFrame([(1, 2)], "x int, y int"), str(tmp_path / "t"), ["y", "x"], "tsv")
    assert spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).select(F.col("y")).first()[0] == "2"


def test_packed_reports_read_as_single_files(spark, tmp_path):
    import __spark_entry__

    text = {"a.txt": "100 + 0 in total\n5 + 0 secondary\n90 + 0 mapped (90%)\n", "b": "7 + 0 in total\n", "empty": ""}
    pack = put(tmp_path, "packed.txt", "".join(f"==> {n} <==\n{t}\n" for n, t in text.items()))
    got = {r.file: (r.total, r.secondary, r.mapped) for r in R.read_flagstat(spark, pack, packed=True).collect()}
    assert got == {"a.txt": (100, 5, 90), "b": (7, None, None), "empty": (None, None, None)}
    vcf = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{0}\nchr1\t5\tx{0}\tN\t<DEL>\t.\tPASS\tEND=9\tGT:CN\t0/1:3\n"
    pack = put(tmp_path, "vcfs.txt", "".join(f"==> f{s} <==\n{vcf.format(s)}" for s in "AB"))
    assert sorted((r.file, r.sample, r.id, r.pos0, r.call["CN"]) for r in R.read_sample_vcf(spark, pack, packed=True).collect()) == [("fA", "A", "xA", 4, "3"), ("fB", "B", "xB", 4, "3")]
    assert R.inventory_sample_vcfs(spark, {"s": pack}, packed=True).first().asDict() == {"source": "s", "files": 2, "samples": 2, "repeated_files": 0}
    pack = put(tmp_path, "jobs.txt", "==> j1 <==\ns\th:m:s\tmax_rss\n1.5\t0:00:01\t-\n==> j2 <==\nmax_rss\ts\n8\t2\n")
    assert sorted(tuple(r) for r in R.read_benchmark(spark, pack, packed=True).collect()) == [("j1", 1.5, None), ("j2", 2.0, 8.0)]
    with pytest.raises(Exception, match="without a name"):
        R.read_flagstat(spark, put(tmp_path, "bad.txt", "100 + 0 in total\n"), packed=True).collect()
    # the queries' reports grow with the tables; the files they lie in do not
    rows = __spark_entry__.queries()["src_15_flagstat"](spark, "/root/testdata/sf0.01")
    assert rows.count() == 100 and len(rows.inputFiles()) < 50
