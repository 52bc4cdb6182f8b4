"""Gene context of alleles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import bins


#: Features of a bin that one row holds while loci meet them; a denser bin is several rows.
ROW_FEATURES = 16_384


def annotation_context(loci: DataFrame, features: DataFrame, types: list[str], width: int = 2_000, most: int = ROW_FEATURES) -> DataFrame:
    """AGG-40: per locus the ids of overlapped features by type (NO_OVERLAP without any) and its gene context.

    Loci: locus_id, chromosome, locus_start, locus_end; features: chromosome, start, end_, feature_type, feature_id. A bin's features stand in order of
    their ids in rows of at most `most`; a locus takes its own from them, so (locus, feature) is never a row and never shuffled. A feature also stands in the bin before
    its own, so a locus of at most `width` bases finds all in the bin where it starts. Only longer loci, and those of a bin of several rows, put their shares together.
    Loci go to their bin in order of place, so that lists which are nearly alike lie side by side where they are stored.
    """
    inside = features.filter(F.col("feature_type").isin(types) & F.col("feature_id").isNotNull()).withColumn("_bin", bins(F.col("start") - width, F.col("end_"), width))
    nth = F.row_number().over(Window.partitionBy("chromosome", "_bin").orderBy("feature_id", "start", "end_"))
    numbered = inside.select("chromosome", "_bin", "feature_type", F.struct("feature_id", "start", "end_").alias("_f"), F.floor((nth - 1) / most).alias("_row"))
    of_type = lambda t: F.array_sort(F.collect_list(F.when(F.col("feature_type") == t, F.col("_f"))))
    rows = numbered.groupBy("chromosome", "_bin", "_row").agg(*(of_type(t).alias(f"_of_{t}") for t in types)).withColumn("_last", F.max("_row").over(Window.partitionBy("chromosome", "_bin")))
    repeated = F.count(F.lit(1)).over(Window.partitionBy("locus_id")) > 1
    own = loci.select("locus_id", "chromosome", "locus_start", "locus_end", repeated.alias("_again"))
    first, last = F.floor(F.col("locus_start") / width), F.floor(F.greatest(F.col("locus_end") - 1, "locus_start") / width)
    short = F.coalesce(F.col("locus_end") - F.col("locus_start") <= width, F.lit(True))
    asked = own.withColumns({"_bin": F.explode_outer(F.when(short, F.array(first)).otherwise(F.sequence(first, last))), "_several": F.col("_again") | ~short})
    asked = asked.repartition("chromosome", "_bin").sortWithinPartitions("chromosome", "_bin", "locus_start", "locus_end")
    asked = asked.withColumn("_nth", F.monotonically_increasing_id()).filter("_nth >= 0")  # a sort right below a join would be taken out
    overlaps = lambda f: (f["start"] < F.col("locus_end")) & (f["end_"] > F.col("locus_start"))
    ids = lambda t: F.coalesce(F.array_distinct(F.transform(F.filter(f"_of_{t}", overlaps), lambda f: f["feature_id"])), F.array().cast("array<string>"))
    met = asked.join(rows, ["chromosome", "_bin"], "left").select("locus_id", (F.col("_several") | (F.coalesce("_last", F.lit(0)) > 0)).alias("_several"), *(ids(t).alias(t) for t in types))
    joined = met.filter("_several").groupBy("locus_id").agg(*(F.array_sort(F.array_distinct(F.flatten(F.collect_list(t)))).alias(t) for t in types))
    again = loci.select(F.col("locus_id").alias("_id")).join(joined, F.col("_id").eqNullSafe(F.col("locus_id"))).select("locus_id", *types)
    found = met.filter("not _several").select("locus_id", *types).unionByName(again)
    found = found.select("locus_id", *(F.when(F.array_join(t, ";") == "", "NO_OVERLAP").otherwise(F.array_join(t, ";")).alias(t) for t in types))
    context = F.lit("INTERGENIC")
    for label, t in (("GENIC", "gene"), ("EXONIC", "exon")):
        if t in types:
            context = F.when(F.col(t) != "NO_OVERLAP", label).otherwise(context)
    return found.withColumn("gene_context", context)


def annotation_queries(loci: DataFrame, flank: int) -> DataFrame:
    """JN-36: up to five search intervals of a locus: itself, both edges, both flanks; UNRESOLVED without coordinates. Loci: locus_id, chromosome, start, end_."""
    part = lambda n, s, e: F.struct(F.lit(n).alias("part"), s.alias("q_start"), e.alias("q_end"))
    s, e = F.col("start"), F.col("end_")
    parts = F.array(
        part("locus", s, e), part("left_edge", F.greatest(s - 1, F.lit(0)), s + 1), part("right_edge", F.greatest(e - 1, F.lit(0)), e + 1),
        part("left_flank", F.greatest(s - flank, F.lit(0)), s), part("right_flank", e, e + flank),
    )
    ready = s.isNotNull() & e.isNotNull() & F.col("chromosome").isNotNull()
    rows = loci.withColumn("_p", F.explode(F.when(ready, parts).otherwise(F.array(part("locus", s, e)))))
    return rows.select("locus_id", "chromosome", "_p.part", "_p.q_start", "_p.q_end", F.when(ready, "READY").otherwise("UNRESOLVED").alias("query_status"))


def counterpart_rows(crosswalk: DataFrame) -> DataFrame:
    """JN-27: the native row and an explicit UNRESOLVED row for the other build. Rows: locus_id, build, chromosome, start, end_."""
    other = F.when(F.col("build") == "GRCh38", "CHM13").otherwise("GRCh38")
    missing = crosswalk.select("locus_id", other.alias("build"), F.lit(None).cast("string").alias("chromosome"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end_"), F.lit("UNRESOLVED").alias("coordinate_status"))
    return crosswalk.select("locus_id", "build", "chromosome", "start", "end_", F.lit("NATIVE").alias("coordinate_status")).unionByName(missing)


def extract_windows(contigs: DataFrame, windows: DataFrame, block: int = 65_536) -> DataFrame:
    """SCL-15: sequence of each window [start, end_) and whether the contig ends before it. Contigs: contig, seq; windows: window_id, contig, start, end_.

    Contigs are cut into blocks; a window meets only its blocks, by an equi-join. A sequence may be a costly expression: no filter reads
    it (an outer explode has none inferred either), since each would compute it again.
    """
    n = F.ceil(F.length("seq") / block).cast("int")
    blocks = contigs.select("contig", F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n - 1))).alias("block"), "seq").filter("block is not null")
    blocks = blocks.select("contig", "block", F.substring("seq", F.col("block") * block + 1, F.lit(block)).alias("part"))
    wanted = windows.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block).cast("int"), F.floor((F.greatest("end_", F.col("start") + 1) - 1) / block).cast("int"))))
    joined = wanted.join(blocks, ["contig", "block"], "left")
    at = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    piece = F.substring("part", (at + 1).cast("int"), (F.least(F.col("end_") - F.col("block") * block, F.lit(block)) - at).cast("int"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", piece.alias("piece")))), lambda x: F.coalesce(x["piece"], F.lit(""))), "")
    found = joined.groupBy("window_id", "contig", "start", "end_").agg(text.alias("window_seq"))
    return found.withColumn("truncated", F.length("window_seq") < F.col("end_") - F.col("start"))


def placement_review(queries: DataFrame, paf: DataFrame, flank: int = 1000, slack: int = 100) -> DataFrame:
    """JN-31: per query all hits, hits at its locus, and those of them that span both query ends with MAPQ 20 to 254.

    Queries: query_id, chromosome, start, end_; hits: query_id, chromosome, qlen, qstart, qend, tstart, tend, mapq.
    """
    j = queries.join(paf.withColumnRenamed("chromosome", "hit_chromosome"), "query_id", "left")
    local = (F.col("hit_chromosome") == F.col("chromosome")) & (F.col("tstart") <= F.col("end_") + flank) & (F.col("tend") >= F.greatest(F.col("start") - flank, F.lit(0)))
    spans = local & (F.col("qstart") <= slack) & (F.col("qend") >= F.col("qlen") - slack) & F.col("mapq").between(20, 254)
    found = j.groupBy("query_id").agg(F.count("hit_chromosome").alias("hits"), F.count_if(local).alias("local_hits"), F.count_if(spans).alias("spanning_hits"))
    return found.withColumn("placement_status", F.when(F.col("spanning_hits") > 0, "REVIEW_ALIGNMENT").otherwise("UNRESOLVED_PLACEMENT"))


def qualify_placements(df: DataFrame, min_coverage: float = 0.95, min_identity: float = 0.95) -> DataFrame:
    """FLT-19: struct of checks and whether all hold. Rows: qlen, qstart, qend, matches, block, mapq, cigar, left_flank_ok, right_flank_ok, allele_ok, n_nodes."""
    checks = {
        "coverage": (F.col("qend") - F.col("qstart")) >= min_coverage * F.col("qlen"), "identity": F.col("matches") >= min_identity * F.col("block"), "mapq": F.col("mapq").between(20, 254),
        "cigar": F.col("cigar").isNotNull(), "flanks": F.col("left_flank_ok") & F.col("right_flank_ok"), "allele": F.col("allele_ok"), "nodes": F.col("n_nodes") >= 2,
    }
    rows = df.withColumn("checks", F.struct(*(c.alias(n) for n, c in checks.items())))
    return rows.withColumn("qualified", F.forall(F.array(*(F.col(f"checks.{n}") for n in checks)), lambda x: F.coalesce(x, F.lit(False))))


def placement_evidence(aln: DataFrame, queries: DataFrame, resources: DataFrame) -> DataFrame:
    """JN-38: alignments of queries with what the query and the resource are; `status` tells an unknown query or a length that disagrees.

    Aln: query_name, resource, qlen and more; queries: query_name, allele_id, locus_id, query_type, query_length;
    resources: resource, resource_version.
    """
    rows = aln.join(queries, "query_name", "left").join(resources, "resource", "left")
    return rows.withColumn("status", F.when(F.col("allele_id").isNull(), "UNKNOWN_QUERY").when(F.col("qlen") != F.col("query_length"), "LENGTH_DISAGREES").otherwise("ALIGNMENT_SCREEN_ONLY"))


def placement_hits(found: DataFrame) -> DataFrame:
    """JN-38: valid hits by allele, resource and part of the query."""
    return found.filter("status = 'ALIGNMENT_SCREEN_ONLY'").groupBy("allele_id", "resource", "query_type").agg(F.count(F.lit(1)).alias("hits"))
