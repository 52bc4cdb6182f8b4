"""Readers of cohort file formats into typed DataFrames. Everything is read as text by Spark, so any file system works.

`mode` is `strict` (a malformed line is an error when the rows are read) or `permissive` (it is left out or flagged).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import format_to_map, info_to_map, tags_to_map

PAF_INTS = {1: "qlen", 2: "qstart", 3: "qend", 6: "tlen", 7: "tstart", 8: "tend", 9: "matches", 10: "block", 11: "mapq"}


def read_table(spark: SparkSession, path: str, sep: str | None = None, required: list[str] | None = None) -> DataFrame:
    """SRC-1: headered table of strings, `,` for .csv and tab otherwise; blanks are null. Missing or repeated columns are an error."""
    sep = sep or ("," if path.removesuffix(".gz").endswith(".csv") else "\t")
    df = spark.read.csv(path, sep=sep, header=True, quote='"', escape='"', maxCharsPerColumn=-1, nullValue="", enforceSchema=False)
    head = spark.read.text(path).first()
    names = [c.strip('"') for c in head[0].split(sep)] if head else []
    if len(set(names)) < len(names):
        raise ValueError(f"repeated columns in {path}")
    if missing := set(required or ()) - set(df.columns):
        raise ValueError(f"missing columns in {path}: {sorted(missing)}")
    return df


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).filter(F.trim("value") != "")


def reports(spark: SparkSession, path: str | list[str], packed: bool = False) -> DataFrame:
    """(file, value): the text of each of many small files.

    A file of its own costs about the same whatever is in it, so a large number of them is better kept `packed`: text files that hold one after
    the other, each behind a line `==> name <==`, as `tail -n +1` prints them. Then `file` is that name. No line of a report may start with `==> `.
    """
    if not packed:
        return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    rows = spark.read.option("lineSep", "\n==> ").text(path).filter(F.trim("value") != "").select(F.regexp_replace("value", "^==> ", "").alias("v"))
    name = F.when(F.col("v").rlike(r"^[^\n]* <==(\n|$)"), F.substring_index("v", " <==", 1)).otherwise(F.raise_error(F.lit("packed report without a name")))
    return rows.withColumn("file", name).select("file", F.expr("substr(v, length(file) + 6)").alias("value"))


def _fields(df: DataFrame) -> DataFrame:
    return df.withColumn("f", F.split(F.col("value"), "\t"))


def _malformed(f: Column) -> Column:
    number = lambda i: F.get(f, F.lit(i)).try_cast("bigint")
    bad_number = F.array_contains(F.array(*(number(i).isNull() for i in PAF_INTS)), True)
    return (F.size(f) < 12) | bad_number | (number(1) < 0) | (number(2) < 0) | (number(3) < number(2)) | (number(3) > number(1))


def read_paf(spark: SparkSession, path: str | list[str], mode: str = "strict") -> DataFrame:
    """SRC-2: 12 typed columns, tags as a map, is_secondary and cigar from them."""
    rows = _fields(_lines(spark, path))
    short = F.size("f") < 12
    rows = rows.withColumn("f", F.when(short, F.raise_error(F.concat(F.lit("PAF line with fewer than 12 columns: "), F.substring("value", 1, 100)))).otherwise(F.col("f"))) if mode == "strict" else rows.filter(~short)
    cast = (lambda c: c.cast("bigint")) if mode == "strict" else (lambda c: c.try_cast("bigint"))
    tags = tags_to_map(F.slice("f", 13, F.greatest(F.size("f") - 12, F.lit(0))))
    cols = [F.col("f")[0].alias("query_name"), F.col("f")[4].alias("strand"), F.col("f")[5].alias("target_name"), *(cast(F.col("f")[i]).alias(n) for i, n in PAF_INTS.items()), tags.alias("tags")]
    return rows.select(*cols).withColumns({"is_secondary": F.coalesce(F.col("tags")["tp"] == "S", F.lit(False)), "cigar": F.col("tags")["cg"]})


def read_gaf(spark: SparkSession, path: str | list[str], mode: str = "permissive") -> DataFrame:
    """SRC-3: as PAF with the path's text and a `malformed` flag; strict mode raises on a malformed line."""
    rows = _fields(_lines(spark, path)).withColumn("malformed", _malformed(F.col("f")))
    if mode == "strict":
        rows = rows.withColumn("f", F.when(F.col("malformed"), F.raise_error(F.concat(F.lit("malformed GAF line: "), F.substring("value", 1, 100)))).otherwise(F.col("f")))
    get = lambda i: F.get("f", F.lit(i))
    tags = tags_to_map(F.slice("f", 13, F.greatest(F.size("f") - 12, F.lit(0))))
    cols = [get(0).alias("read_name"), get(4).alias("strand"), get(5).alias("path"), *(get(i).try_cast("bigint").alias(n) for i, n in PAF_INTS.items()), tags.alias("tags"), F.col("malformed")]
    return rows.select(*cols).withColumns({"is_secondary": F.coalesce(F.col("tags")["tp"] == "S", F.lit(False)), "cigar": F.col("tags")["cg"]})


def read_gfa(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC-5: (segments, links, walks). A segment's length is its sequence's, or its LN tag's where the sequence is `*`."""
    rows = _fields(_lines(spark, path))
    record = lambda k: rows.filter(F.col("f")[0] == k)
    tags = lambda n: tags_to_map(F.slice("f", n, F.greatest(F.size("f") - n + 1, F.lit(0))))
    seq = F.col("f")[2]
    segments = record("S").withColumn("t", tags(4)).select(
        F.col("f")[1].alias("segment_id"), F.when(seq == "*", F.col("t")["LN"].try_cast("bigint")).otherwise(F.length(seq).cast("bigint")).alias("ln"), F.col("t")["SN"].alias("sn"), F.col("t")["SO"].try_cast("bigint").alias("so"),
        F.col("t")["SR"].try_cast("bigint").alias("sr"), F.col("t")["LN"].try_cast("bigint").alias("ln_tag"), F.when(seq != "*", F.sha2(F.upper(seq), 256)).alias("seq_sha256"),
    )
    links = record("L").withColumn("t", tags(7)).select(F.col("f")[1].alias("left_id"), F.col("f")[2].alias("left_orient"), F.col("f")[3].alias("right_id"), F.col("f")[4].alias("right_orient"), F.get("f", F.lit(5)).alias("overlap"), F.col("t")["SR"].try_cast("bigint").alias("sr"))
    walks = rows.filter(F.col("f")[0].isin("P", "W")).select(F.col("f")[0].alias("record_type"), F.col("f")[1].alias("name"), F.slice("f", 3, F.size("f")).alias("fields"))
    return segments, links, walks


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: contig, description, seq, length, n_count. Text before the first header and an empty name are errors. One record is one cell."""
    rows = spark.read.option("lineSep", "\n>").text(path).withColumn("file", F.input_file_name())
    body = F.regexp_replace(F.col("value"), "^>", "")
    head = F.substring_index(body, "\n", 1)
    seq = F.regexp_replace(F.substring(body, F.length(head) + 1, F.length(body)), r"\s", "")
    name = F.regexp_extract(head, r"^(\S*)", 1)
    starts = (F.col("value").startswith(">")) | ~F.col("value").contains("\n") | (name != "")
    checked = F.when(~starts | (name == ""), F.raise_error(F.lit("FASTA record without a name"))).otherwise(name)
    out = rows.filter(F.trim("value") != "").select(checked.alias("contig"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), seq.alias("seq"))
    return out.withColumns({"length": F.length("seq").cast("bigint"), "n_count": (F.length("seq") - F.length(F.translate("seq", "Nn", ""))).cast("bigint")})


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-7: file, idx, name, seq, qual. A record is four lines, of which any may start with `@`: a line's role follows from its number.

    Lines are read by split, so a large file is many tasks. A split's lines are numbered from where the counts of the file's splits before
    it end (one small row a split), and each record's lines meet in one row. A gzipped file is one split.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("m"))
    splits = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    numbered = lines.join(splits.withColumn("before", F.coalesce(before, F.lit(0))), ["file", "split"]).withColumn("i", F.col("m") - F.col("first") + F.col("before"))
    line = lambda k: F.max(F.when(F.col("i") % 4 == k, F.col("value")))
    rows = numbered.groupBy("file", F.floor(F.col("i") / 4).alias("idx")).agg(line(0).alias("head"), line(1).alias("seq"), line(2).alias("plus"), line(3).alias("qual"))
    bad = F.when(F.col("plus").isNull() | F.col("qual").isNull() | F.col("seq").isNull(), "truncated FASTQ record in ").when(~F.col("head").startswith("@") | ~F.col("plus").startswith("+") | (F.length("seq") != F.length("qual")), "bad FASTQ record in ")
    checked = F.when(bad.isNotNull(), F.raise_error(F.concat(bad, F.col("file")))).otherwise(F.substring("head", 2, 1 << 30))
    return rows.select("file", "idx", checked.alias("name"), "seq", "qual")


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-8: site rows with INFO as a map; several alleles stay in one row. pos0 is 0-based."""
    rows = _fields(_lines(spark, path).filter(~F.col("value").startswith("#")))
    f = F.col("f")
    checked = F.when(F.size("f") < 8, F.raise_error(F.lit("VCF line with fewer than 8 columns"))).otherwise(f[0])
    return rows.select(checked.alias("chromosome"), (f[1].cast("bigint") - 1).alias("pos0"), f[2].alias("id"), f[3].alias("ref"), F.split(f[4], ",").alias("alts"), f[5].alias("qual"), f[6].alias("filter"), info_to_map(f[7]).alias("info"))


def read_sample_vcf(spark: SparkSession, path: str | list[str], packed: bool = False) -> DataFrame:
    """SRC-9: rows of one-sample files with the header's sample name and the FORMAT map; exactly 10 columns. Small files may be `packed` (see `reports`)."""
    if packed:
        rows = reports(spark, path, True).select("file", F.explode(F.split("value", "\n")).alias("value"), _vcf_header())
    else:
        rows = spark.read.text(path).withColumn("file", F.input_file_name())
    sample = F.when(F.size("h") == 10, F.col("h")[9]).otherwise(F.raise_error(F.lit("not a one-sample VCF")))
    body = _fields(rows.filter(~F.col("value").startswith("#") & (F.trim("value") != "")))
    f = F.col("f")
    site = [f[0].alias("chromosome"), (f[1].cast("bigint") - 1).alias("pos0"), f[2].alias("id"), f[3].alias("ref"), f[4].alias("alt"), f[6].alias("filter"), info_to_map(f[7]).alias("info"), format_to_map(f[8], f[9]).alias("call")]
    if packed:  # a report's header lies where its rows are; one without a header has no rows, as in the join below
        return body.filter("h is not null").select("file", *site, sample.alias("sample"))
    header = rows.filter(F.col("value").startswith("#CHROM")).select("file", F.split("value", "\t").alias("h")).select("file", sample.alias("sample"))
    return body.select("file", *site).join(header, "file")


def _vcf_header() -> Column:
    """The header's fields of a whole VCF in `value`, as `h`; null without one."""
    line = F.regexp_extract("value", r"(?m)^#CHROM[^\n]*", 0)
    return F.when(line != "", F.split(line, "\t")).alias("h")


def inventory_sample_vcfs(spark: SparkSession, sources: dict[str, str], packed: bool = False) -> DataFrame:
    """SRC-22: files, distinct samples and repeated files of each source, from header lines only. Small files may be `packed` (see `reports`)."""
    parts = []
    for name, path in sources.items():
        if packed:
            heads = reports(spark, path, True).select("file", _vcf_header()).filter("h is not null")
        else:
            heads = spark.read.text(path).filter(F.col("value").startswith("#CHROM")).select(F.input_file_name().alias("file"), F.split("value", "\t").alias("h"))
        parts.append(heads.select(F.lit(name).alias("source"), "file", F.get("h", F.lit(9)).alias("sample")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("sample").alias("samples")).withColumn("repeated_files", F.col("files") - F.col("samples"))


def read_taxon_report(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """SRC-10: percent, clade, direct, rank, taxid, name and depth (two leading blanks a level), from reports of 6 or 8 columns. `line` keeps the order."""
    rows = _fields(reports(spark, path, packed).select("file", F.posexplode(F.split(F.regexp_replace("value", r"\s+$", ""), "\n")).alias("line", "value")))
    wide = F.size("f") == 8
    at = lambda i: F.get("f", F.when(wide, i + 2).otherwise(i))
    name = F.when(F.size("f").isin(6, 8), at(5)).otherwise(F.raise_error(F.lit("taxon report with other than 6 or 8 columns")))
    raw = rows.select("file", "line", F.trim(F.col("f")[0]).cast("double").alias("percent"), F.col("f")[1].cast("bigint").alias("clade"), F.col("f")[2].cast("bigint").alias("direct"), at(3).alias("rank"), F.trim(at(4)).cast("bigint").alias("taxid"), name.alias("_name"))
    return raw.select("file", "line", "percent", "clade", "direct", "rank", "taxid", F.trim("_name").alias("name"), ((F.length("_name") - F.length(F.ltrim("_name"))) / 2).cast("int").alias("depth"))


def inherit_group(report: DataFrame, targets: dict[int, str], max_depth: int = 40) -> DataFrame:
    """WIN-9: taxon_group of every row: its own or its nearest listed ancestor's.

    The parent of a row is the last row before it that is one level higher; one ordered pass over a report (a few ten
    thousand rows) keeps the group of each level.
    """
    wanted = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]) if targets else F.lit(None).cast("map<int,string>")
    own = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = report.withColumn("_own", wanted[F.col("taxid").cast("int")])
    for d in range(max_depth):  # one window specification: Spark runs all levels in one pass
        rows = rows.withColumn(f"_at{d}", F.max_by(F.struct("line", F.col("_own").alias("g")), F.when(F.col("depth") == d, F.col("line"))).over(own))
    # an ancestor of level d counts if no row of a level at most d came after it: then it lies on the path
    candidates = []
    for d in reversed(range(max_depth)):
        fresh = F.forall(F.array(*(F.coalesce(F.col(f"_at{e}.line") <= F.col(f"_at{d}.line"), F.lit(True)) for e in range(d))), lambda x: x) if d else F.lit(True)
        candidates.append(F.when((F.col("depth") >= d) & fresh, F.col(f"_at{d}.g")))
    return rows.withColumn("taxon_group", F.coalesce(*candidates)).drop("_own", *(f"_at{d}" for d in range(max_depth)))


def read_taxon_calls(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: status, contig, taxid of each classified contig."""
    rows = _fields(_lines(spark, path))
    f = F.when(F.size("f") >= 5, F.col("f")).otherwise(F.raise_error(F.lit("call line with fewer than 5 columns")))
    return rows.withColumn("f", f).select(F.col("f")[0].alias("status"), F.col("f")[1].alias("contig"), F.col("f")[2].cast("bigint").alias("taxid"))


def read_blast(spark: SparkSession, groups: dict[str, str]) -> DataFrame:
    """SRC-12: hits of 9 columns by group; start = min(query ends) - 1."""
    out = None
    for name, path in groups.items():
        f = F.col("f")
        part = _fields(_lines(spark, path)).select(f[0].alias("contig"), f[1].alias("subject"), f[2].cast("double").alias("identity"), (F.least(f[4].cast("bigint"), f[5].cast("bigint")) - 1).alias("start"), F.greatest(f[4].cast("bigint"), f[5].cast("bigint")).alias("end_"), F.lit(name).alias("grp"))
        out = part if out is None else out.unionByName(part)
    return out


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-13: chromosome, start, end_, name; comments and track lines are skipped, bad coordinates are an error."""
    rows = _fields(_lines(spark, path).filter(~F.col("value").rlike("^(#|track|browser)")))
    f = F.col("f")
    s, e = f[1].cast("bigint"), f[2].cast("bigint")
    ok = (F.size("f") >= 3) & (s >= 0) & (e > s)
    return rows.select(F.when(ok, f[0]).otherwise(F.raise_error(F.lit("bad BED line"))).alias("chromosome"), s.alias("start"), e.alias("end_"), F.get("f", F.lit(3)).alias("name"))


def read_bubbles(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """SRC-14: graph bubbles of 12 or 14 columns, by graph."""
    out = None
    for name, path in paths.items():
        f = F.col("f")
        rows = _fields(_lines(spark, path)).withColumn("f", F.when(F.size("f").isin(12, 14), f).otherwise(F.raise_error(F.lit("bubble line with other than 12 or 14 columns"))))
        part = rows.select(F.lit(name).alias("graph"), f[0].alias("chromosome"), f[1].cast("bigint").alias("start"), f[2].cast("bigint").alias("end_"), f[5].cast("int").alias("is_inversion"), f[6].cast("bigint").alias("shortest"), f[7].cast("bigint").alias("longest"), F.split(f[11], ",").alias("segments"), F.get("f", F.lit(12)).alias("shortest_seq"), F.get("f", F.lit(13)).alias("longest_seq"))
        out = part if out is None else out.unionByName(part)
    return out


def read_seq_stats(spark: SparkSession, path: str) -> DataFrame:
    """SRC-15: sequence statistics with thousands separators and alternative names."""
    df = read_table(spark, path)
    number = lambda *names: F.coalesce(*(F.regexp_replace(F.col(f"`{n}`"), ",", "").cast("double") for n in names if n in df.columns))
    return df.select(F.col(df.columns[0]).alias("file"), number("num_seqs").alias("contig_count"), number("sum_len").alias("total_length_bp"), number("N50", "N50_num").alias("contig_n50_bp"), number("max_len").alias("largest_bp"), number("GC(%)", "GC").alias("gc_percent"), number("sum_n").alias("n_bases"))


def read_completeness(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """SRC-15: one row a file: percents of complete, duplicated, fragmented and missing genes."""
    text = reports(spark, path, packed)
    part = lambda k: F.regexp_extract("value", rf"(?m)^#?\s*{k}:\s*([0-9.]+)%", 1).try_cast("double")
    return text.select("file", (part("S") + part("D")).alias("complete_percent"), part("D").alias("duplicated_percent"), part("F").alias("fragmented_percent"), part("M").alias("missing_percent"))


def read_flagstat(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """SRC-15: total, secondary, mapped and properly paired counts."""
    text = reports(spark, path, packed)
    part = lambda k: F.regexp_extract("value", rf"(?m)^([0-9]+) \+ [0-9]+ {k}", 1).try_cast("bigint")
    return text.select("file", part("in total").alias("total"), part("secondary").alias("secondary"), part("mapped").alias("mapped"), part("properly paired").alias("properly_paired"))


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """SRC-15: name, length, covered bases and depth of each reference."""
    f = F.col("f")
    return _fields(_lines(spark, path).filter(~F.col("value").startswith("#"))).select(f[0].alias("name"), (f[2].cast("bigint") - f[1].cast("bigint") + 1).alias("length"), f[4].cast("bigint").alias("covered"), f[6].cast("double").alias("depth"))


def read_benchmark(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """SRC-15: seconds and peak memory of each job file, by its own header."""
    if not packed:
        return spark.read.csv(path, sep="\t", header=True).select(F.input_file_name().alias("file"), F.col("s").cast("double").alias("seconds"), F.col("max_rss").try_cast("double").alias("max_rss_mb"))
    lines = reports(spark, path, True).select("file", F.split(F.regexp_replace("value", r"\s+$", ""), "\r?\n").alias("l"))
    rows = lines.select("file", F.split(F.col("l")[0], "\t").alias("h"), F.explode(F.slice("l", 2, F.size("l"))).alias("v")).filter("v <> ''")
    value = lambda n: F.nullif(F.get(F.split("v", "\t"), (F.array_position("h", F.lit(n)) - 1).cast("int")), F.lit(""))
    return rows.select("file", value("s").cast("double").alias("seconds"), value("max_rss").try_cast("double").alias("max_rss_mb"))


EDIT = T.StructType([T.StructField("from_length", T.LongType()), T.StructField("to_length", T.LongType()), T.StructField("sequence", T.StringType())])
MAPPING = T.StructType([T.StructField("position", T.StructType([T.StructField("node_id", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("is_reverse", T.BooleanType())])), T.StructField("edit", T.ArrayType(EDIT))])
ALIGNMENT = T.StructType([T.StructField("name", T.StringType()), T.StructField("mapping_quality", T.LongType()), T.StructField("is_secondary", T.BooleanType()), T.StructField("path", T.StructType([T.StructField("mapping", T.ArrayType(MAPPING))]))])


def read_alignment_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC-16: nested graph alignments, one JSON object a line."""
    return spark.read.schema(ALIGNMENT).json(path)


def alignment_edits(aln: DataFrame) -> DataFrame:
    """Edits of nested alignments in order, with node, exactness and whether they open a node (the input of anchored edges)."""
    steps = aln.select(F.col("name").alias("read_id"), F.posexplode("path.mapping").alias("m", "mapping"))
    edits = steps.select("read_id", "m", F.concat(F.when(F.col("mapping.position.is_reverse"), "<").otherwise(">"), F.col("mapping.position.node_id")).alias("node"), F.posexplode("mapping.edit").alias("e", "edit"))
    exact = (F.col("edit.from_length") == F.col("edit.to_length")) & (F.coalesce(F.col("edit.sequence"), F.lit("")) == "")
    return edits.select("read_id", (F.col("m") * 1_000_000 + F.col("e")).alias("step"), "node", F.coalesce(exact, F.lit(False)).alias("exact"), F.coalesce("edit.to_length", F.lit(0)).alias("length"), (F.col("e") == 0).alias("new_node"))


def read_repeat_hits(spark: SparkSession, path: str) -> DataFrame:
    """SRC-21: repeat annotation: name:class:start-end of each query; header lines are skipped, start and end are checked."""
    rows = _lines(spark, path).withColumn("f", F.split(F.trim("value"), r"\s+")).filter(F.col("f")[0].rlike("^[0-9]+$"))
    f = F.col("f")
    s, e = f[5].cast("bigint") - 1, f[6].cast("bigint")
    ok = (s >= 0) & (e > s)
    return rows.select(f[4].alias("query_id"), F.when(ok, s).otherwise(F.raise_error(F.lit("bad repeat coordinates"))).alias("start"), e.alias("end_"), F.concat(f[9], F.lit(":"), f[10], F.lit(":"), s.cast("string"), F.lit("-"), e.cast("string")).alias("repeat"))


def select_repeat_catalog(text: DataFrame, wanted: DataFrame) -> DataFrame:
    """SCL-31: regions of wanted repeat loci, one row a region, with FOUND or NOT_IN_CATALOG. `text` has a JSON object in `value`; region and type may be one value or a list."""
    j = F.col("value")
    many = lambda k: F.coalesce(F.from_json(F.get_json_object(j, f"$.{k}"), "array<string>"), F.array(F.get_json_object(j, f"$.{k}")))
    rows = text.select(F.get_json_object(j, "$.LocusId").alias("locus_id"), F.explode(F.arrays_zip(many("ReferenceRegion").alias("region"), many("VariantType").alias("kind"))).alias("z"))
    pattern = "^(.+):([0-9]+)-([0-9]+)$"
    part = lambda i: F.regexp_extract("z.region", pattern, i)
    found = rows.select("locus_id", F.col("z.kind").alias("variant_type"), part(1).alias("chromosome"), part(2).cast("bigint").alias("start"), part(3).cast("bigint").alias("end_"))
    return wanted.join(found, "locus_id", "left").withColumn("catalog_status", F.when(F.col("chromosome").isNull(), "NOT_IN_CATALOG").otherwise("FOUND"))


def contig_map(contigs: DataFrame) -> DataFrame:
    """SRC-23: effective id of each contig: last `#` part, first word, `:` as `_` except before a sub-range, and its sample#hap#contig name. Rows: sample, hap, header."""
    last = F.substring_index(F.split("header", r"\s")[0], "#", -1)
    effective = F.regexp_replace(last, r":(?![0-9]+-[0-9]+$)", "_")
    rows = contigs.withColumn("contig", effective)
    return rows.withColumn("source_name", F.concat_ws("#", F.col("sample"), F.col("hap").cast("string"), F.col("contig")))


def union_tables(frames: list[DataFrame], strict: bool = True) -> DataFrame:
    """SRC-17: all rows of tables with one header; unless strict, columns are united by name."""
    out = frames[0]
    for df in frames[1:]:
        if strict and df.columns != out.columns:
            raise ValueError(f"headers differ: {out.columns} and {df.columns}")
        out = out.unionByName(df, allowMissingColumns=not strict)
    return out


def write_table(df: DataFrame, path: str, fields: list[str] | None = None, fmt: str = "parquet") -> None:
    """SRC-19: stable column order; Parquet, or gzipped tab-separated text with a header."""
    out = df.select(*(fields or df.columns))
    out.write.parquet(path) if fmt == "parquet" else out.write.csv(path, sep="\t", header=True, compression="gzip")


def write_fasta(df: DataFrame, path: str, wrap: int = 80, prefix: str = "") -> None:
    """SRC-20: records from contig, seq, wrapped."""
    wrapped = F.regexp_replace("seq", f"(.{{{wrap}}})(?=.)", "$1\n")
    df.select(F.concat(F.lit(f">{prefix}"), F.col("contig"), F.lit("\n"), wrapped).alias("value")).write.text(path)
