"""Assembly quality, contamination decisions and manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import join_reasons
from .intervals import complement_intervals, merge_intervals, union_length, union_lengths

# What is measured of an assembly and how a limit bounds it, in the order in which reasons are told.
BOUNDED = {
    "total_length_bp": "min max", "contig_n50_bp": "min", "n_percent": "max", "compleasm_complete_percent": "min", "compleasm_duplicated_percent": "max",
    "best_query_aligned_percent": "min", "best_reference_covered_percent": "min", "best_alignment_identity_percent": "min",
}


def limits_on(*metrics: str) -> tuple[tuple[str, str, str], ...]:
    """(metric, operator, name of the limit) of the metrics, of all of them by default. A limit is named after its metric: min_ or max_ and the metric."""
    return tuple((m, ">=" if side == "min" else "<=", f"{side}_{m}") for m in metrics or BOUNDED for side in BOUNDED[m].split())


def classify_thresholds(df: DataFrame, fail: dict[str, float], warn: dict[str, float], checks: tuple | None = None) -> DataFrame:
    """FLT-1: assembly_status PASS, WARN or FAIL with fail_reasons and warning_reasons. Limits themselves pass."""
    checks = checks or limits_on()

    def beyond(metric: str, op: str, limit: float) -> Column:
        return F.col(metric) < limit if op == ">=" else F.col(metric) > limit

    def text(metric: str, op: str, limit: float) -> Column:
        return F.format_string(f"{metric}{op}{limit:g} (observed %.3f)", F.col(metric).cast("double"))

    failures = join_reasons(*((beyond(m, op, fail[n]), text(m, op, fail[n])) for m, op, n in checks), separator="; ")
    warnings = join_reasons(*((~beyond(m, op, fail[n]) & beyond(m, op, warn[n]), text(m, op, warn[n])) for m, op, n in checks), separator="; ")
    found = df.withColumns({"fail_reasons": failures, "warning_reasons": warnings})
    return found.withColumn("assembly_status", F.when(F.col("fail_reasons") != "", "FAIL").when(F.col("warning_reasons") != "", "WARN").otherwise("PASS"))


def sample_decisions(df: DataFrame, allow_missing_mates: bool = False) -> DataFrame:
    """FLT-2: one row for each sample with status and reasons, from rows sample, haplotype, assembly_status, fail_reasons."""
    status = lambda h: F.coalesce(F.max(F.when(F.col("haplotype") == h, F.col("assembly_status"))), F.lit("MISSING"))
    count = lambda h: F.count_if(F.col("haplotype") == h)
    failed = F.array_sort(F.collect_list(F.when(F.col("assembly_status") == "FAIL", F.concat(F.col("haplotype"), F.lit(": "), F.col("fail_reasons")))))
    g = df.groupBy("sample").agg(
        status("hap1").alias("hap1_status"), status("hap2").alias("hap2_status"), count("hap1").alias("_n1"), count("hap2").alias("_n2"), F.count_if(F.col("assembly_status") == "FAIL").alias("_failed"),
        F.count_if(F.col("assembly_status") == "WARN").alias("_warned"), F.count(F.lit(1)).alias("_n"), failed.alias("_texts"),
    )
    names = lambda test: F.array_join(F.filter(F.array(F.when(test(F.col("_n1")), F.lit("hap1")), F.when(test(F.col("_n2")), F.lit("hap2"))), lambda x: x.isNotNull()), ",")
    g = g.withColumns({"_missing": names(lambda n: n == 0), "_twice": names(lambda n: n > 1)})
    missing_text = F.when(F.col("_missing") != "", F.concat(F.lit("mate absent from post-decontamination input: " if allow_missing_mates else "missing "), F.col("_missing")))
    twice_text = F.when(F.col("_twice") != "", F.concat(F.lit("duplicate assembly for "), F.col("_twice")))
    pair_error = F.col("_twice") != "" if allow_missing_mates else (F.col("_missing") != "") | (F.col("_twice") != "")
    sample_status = F.when(pair_error | (F.col("_failed") == F.col("_n")), "FAIL").when((F.col("_failed") > 0) | (F.col("_missing") != ""), "PARTIAL").when(F.col("_warned") > 0, "WARN").otherwise("PASS")
    first = F.array(twice_text, missing_text) if allow_missing_mates else F.array(missing_text, twice_text)
    reasons = F.array_join(F.concat(F.filter(first, lambda x: x.isNotNull()), F.col("_texts")), "; ")
    return g.select("sample", sample_status.alias("sample_status"), "hap1_status", "hap2_status", reasons.alias("reasons"), pair_error.alias("pair_error"))


def split_inclusion(df: DataFrame, decisions: DataFrame) -> DataFrame:
    """FLT-2, second part: every assembly with `included`."""
    return df.join(decisions.select("sample", "pair_error"), "sample").withColumn("included", ~F.col("pair_error") & (F.col("assembly_status") != "FAIL")).drop("pair_error")


def classify_contigs_intervals(lengths: DataFrame, human: DataFrame, nonhuman: DataFrame, limits: dict[str, float]) -> DataFrame:
    """FLT-3: REMOVE, SPLIT, REVIEW or KEEP from covered bases. Keys: assembly_id, contig; intervals start, end_."""
    keys = ["assembly_id", "contig"]
    both = nonhuman.select(*keys, "start", "end_", F.lit(True).alias("_n")).unionByName(human.select(*keys, "start", "end_", F.lit(False).alias("_n")))
    covered = union_lengths(both, keys, {"nonhuman_bp": F.col("_n"), "human_bp": ~F.col("_n"), "_all": F.lit(True)}, largest={"largest_block_bp": "nonhuman_bp"})
    rows = lengths.join(covered.withColumn("overlap_bp", F.col("nonhuman_bp") + F.col("human_bp") - F.col("_all")).drop("_all"), keys, "left")
    rows = rows.fillna(0, ["nonhuman_bp", "largest_block_bp", "human_bp", "overlap_bp"])
    percent = lambda a, b: F.when(F.col(b) > 0, 100.0 * F.col(a) / F.col(b)).otherwise(0.0)
    rows = rows.withColumns({"nonhuman_percent": percent("nonhuman_bp", "length"), "human_percent": percent("human_bp", "length"), "overlap_percent": percent("overlap_bp", "nonhuman_bp"), "human_outside_bp": F.greatest(F.col("human_bp") - F.col("overlap_bp"), F.lit(0))})
    remove = (F.col("nonhuman_bp") >= limits["remove_min_nonhuman_bp"]) & (F.col("nonhuman_percent") >= limits["remove_min_nonhuman_percent"]) & (F.col("human_percent") <= limits["remove_max_human_percent"])
    split = (
        (F.col("nonhuman_bp") >= limits["split_min_nonhuman_bp"])
        & (F.col("nonhuman_percent") >= limits["split_min_nonhuman_percent"])
        & (F.col("nonhuman_percent") < limits["remove_min_nonhuman_percent"])
        & (F.col("overlap_percent") <= limits["split_max_human_overlap_percent"])
        & (F.col("human_outside_bp") >= limits["split_min_human_outside_bp"])
    )
    return rows.withColumn("decision", F.when(remove, "REMOVE").when(split, "SPLIT").when(F.col("nonhuman_bp") >= limits["review_min_nonhuman_bp"], "REVIEW").otherwise("KEEP"))


def classify_contigs_taxonomy(lengths: DataFrame, human: DataFrame, calls: DataFrame, targets: DataFrame, max_human: float = 10.0) -> DataFrame:
    """FLT-4: contigs called to a target group: REMOVE with at most `max_human` percent human support, else REVIEW; all others KEEP.

    `human`: intervals start, end_ of accepted human alignments; `calls`: taxid; `targets`: taxid, taxon_group.
    """
    keys = ["assembly_id", "contig"]
    rows = lengths.join(union_length(human, keys, name="human_bp"), keys, "left").join(calls, keys, "left").join(F.broadcast(targets), "taxid", "left").fillna(0, ["human_bp"])
    rows = rows.withColumn("human_percent", F.when(F.col("length") > 0, 100.0 * F.col("human_bp") / F.col("length")).otherwise(0.0))
    return rows.withColumn("decision", F.when(F.col("taxon_group").isNull(), "KEEP").when(F.col("human_percent") <= max_human, "REMOVE").otherwise("REVIEW")).select(*keys, "length", "human_bp", "human_percent", "taxon_group", "decision")


def apply_decisions(contigs: DataFrame, decisions: DataFrame, split: DataFrame, prefix: str = "") -> DataFrame:
    """FLT-5: kept and removed parts with coordinates: (contig, part, start, end_, action). SPLIT removes the intervals of `split` and keeps what is left.

    Contigs: contig, length; decisions: contig, decision; split: contig, start, end_. Names of parts count from 1.
    """
    joined = contigs.join(decisions, "contig", "left")
    whole = joined.filter(F.coalesce(F.col("decision") != "SPLIT", F.lit(True))).select(
        "contig", F.concat(F.lit(prefix), F.col("contig")).alias("part"), F.lit(0).cast("long").alias("start"), F.col("length").alias("end_"),
        F.when(F.col("decision").isNull(), F.raise_error(F.lit("contig without decision"))).when(F.col("decision") == "REMOVE", "REMOVED").when(F.col("decision") == "REVIEW", "REVIEW").otherwise("KEPT").alias("action"),
    )
    own = joined.filter("decision = 'SPLIT'").select("contig", "length")
    cut = merge_intervals(split.join(own.select("contig"), "contig", "left_semi"), ["contig"]).withColumn("action", F.lit("REMOVED"))
    rest = complement_intervals(split, own, ["contig"]).withColumn("action", F.lit("KEPT"))
    nth = F.row_number().over(Window.partitionBy("contig", "action").orderBy("start"))
    label = F.when(F.col("action") == "KEPT", "clean").otherwise("removed")
    parts = cut.unionByName(rest).withColumn("part", F.concat(F.lit(prefix), F.col("contig"), F.lit("__"), label, F.lit("_part"), nth.cast("string"), F.lit("__"), F.col("start").cast("string"), F.lit("_"), F.col("end_").cast("string")))
    return whole.unionByName(parts.select(whole.columns))


def contamination_summary(decisions: DataFrame, assemblies: DataFrame) -> DataFrame:
    """AGG-8: contigs and bases by decision for every assembly, zeros included."""
    pick = lambda d: F.col("decision") == d
    aggs = [x for d in ("REMOVE", "REVIEW", "SPLIT") for x in (F.count_if(pick(d)).alias(f"{d.lower()}_contigs"), F.sum(F.when(pick(d), F.col("length")).otherwise(0)).alias(f"{d.lower()}_bp"))]
    sums = decisions.groupBy("assembly_id").agg(F.count(F.lit(1)).alias("contigs"), *aggs)
    return assemblies.join(sums, "assembly_id", "left").fillna(0)


def nonhuman_evidence(hits: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-7."""
    return hits.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("grp")), ";").alias("groups"), F.max("identity").alias("best_identity"), F.count(F.lit(1)).alias("hits"), F.max(F.col("end_") - F.col("start")).alias("largest_hit_bp"))


def n50(df: DataFrame, key: list[str], length: str) -> DataFrame:
    """AGG-2: the length at which the running sum of falling lengths reaches half. Equal lengths are summed first."""
    sizes = df.filter(F.col(length) > 0).groupBy(*key, length).agg(F.sum(length).alias("_bp"))
    own = Window.partitionBy(*key)
    run = sizes.withColumns({"_run": F.sum("_bp").over(own.orderBy(F.desc(length)).rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("_bp").over(own)})
    return run.filter(2 * F.col("_run") >= F.col("_all")).groupBy(*key).agg(F.max(length).alias("n50"))


def sequence_stats(contigs: DataFrame, key: str = "assembly_id") -> DataFrame:
    """AGG-1: from rows length, n_count, gc_count."""
    sums = contigs.groupBy(key).agg(F.count(F.lit(1)).alias("contigs"), F.sum("length").alias("total_bp"), F.max("length").alias("largest_bp"), F.sum("n_count").alias("n_bases"), F.sum("gc_count").alias("_gc"))
    joined = sums.join(n50(contigs, [key], "length"), key, "left")
    percent = lambda c: F.when(F.col("total_bp") > 0, 100.0 * c / F.col("total_bp"))
    return joined.select(key, "contigs", "total_bp", "n50", "largest_bp", F.coalesce(percent(F.col("_gc")), F.lit(0.0)).alias("gc_percent"), "n_bases", F.coalesce(percent(F.col("n_bases")), F.lit(100.0)).alias("n_percent"))


def build_manifest(cleaned: DataFrame, *lookups: DataFrame, key: str = "assembly_id") -> DataFrame:
    """JN-1: the cleaned list with every lookup joined by `key`, and the mate haplotype's id and status from the list itself."""
    joined = reduce(lambda a, b: a.join(b, key, "left"), lookups, cleaned)
    mates = joined.select("sample", F.when(F.col("haplotype") == "hap1", "hap2").otherwise("hap1").alias("haplotype"), F.col(key).alias("mate_id"), F.col("assembly_status").alias("mate_assembly_status"))
    return joined.join(mates, ["sample", "haplotype"], "left").withColumn("mate_status", F.coalesce("mate_assembly_status", F.lit("MISSING"))).drop("mate_assembly_status")


def classify_rescue(df: DataFrame) -> DataFrame:
    """FLT-13: tier, priority and action from original and cleaned status."""
    tier = F.when((F.col("assembly_status") == "PASS") & F.col("graph_member"), "graph_control").when(F.col("assembly_status") == "PASS", "primary").when(F.col("assembly_status") == "WARN", "fragmented_rescue").otherwise("not_recommended")
    action = {"graph_control": "use as control", "primary": "screen", "fragmented_rescue": "request long reads", "not_recommended": "do not use"}
    rows = df.withColumn("rescue_tier", tier)
    priority = F.when(F.col("rescue_tier") == "primary", 1).when(F.col("rescue_tier") == "fragmented_rescue", 2).when(F.col("rescue_tier") == "graph_control", 3).otherwise(4)
    return rows.withColumns({"priority": priority, "required_action": F.create_map(*[F.lit(x) for kv in action.items() for x in kv])[F.col("rescue_tier")]})


def provisional_requests(manifest: DataFrame) -> DataFrame:
    """TOP-2: samples with a low-tier haplotype that is no graph member, the most urgent first."""
    low = F.col("rescue_tier").isin("fragmented_rescue", "not_recommended") & ~F.col("graph_member")
    g = manifest.groupBy("sample").agg(F.count_if(low).alias("low_haplotypes"), F.min("priority").alias("priority"))
    return g.filter("low_haplotypes > 0").withColumn("request_rank", F.row_number().over(Window.orderBy(F.desc("low_haplotypes"), "priority", "sample")))


def mash_outliers(df: DataFrame, distance: str = "mash_distance", fraction: str = "hash_fraction", k: float = 3.5, low: float = 0.9) -> DataFrame:
    """AGG-22: median, MAD, score and flag; a MAD of 0 gives scores of 0 and still flags distances above the median."""
    median = df.agg(F.median(distance).alias("median_distance"))
    mad = df.crossJoin(F.broadcast(median)).agg(F.median(F.abs(F.col(distance) - F.col("median_distance"))).alias("mad"))
    rows = df.crossJoin(F.broadcast(median)).crossJoin(F.broadcast(mad))
    score = F.when(F.col("mad") > 0, (F.col(distance) - F.col("median_distance")) / F.col("mad")).otherwise(0.0)
    return rows.withColumns({"mad_score": score, "outlier": (F.col(distance) > F.col("median_distance") + k * F.col("mad")) | (F.col(fraction) < low)})


def haplotype_pivot(df: DataFrame, value: str = "mash_distance") -> DataFrame:
    """AGG-23."""
    wide = df.groupBy("sample").pivot("haplotype", ["hap1", "hap2"]).agg(F.first(value))
    return wide.withColumn("difference", F.abs(F.col("hap1") - F.col("hap2")))


def build_tasks(manifest: DataFrame, batch: int, order: list[str]) -> DataFrame:
    """WIN-6: task index in `order` and its batch id. A manifest has a row for each assembly, so one window orders it."""
    index = F.row_number().over(Window.orderBy(*order))
    return manifest.withColumn("task_index", index).withColumn("batch_id", F.concat(F.lit("batch_"), F.lpad((F.floor((F.col("task_index") - 1) / batch) + 1).cast("string"), 4, "0")))


def build_order(distances: DataFrame, references: list[str], descending: bool = False) -> DataFrame:
    """WIN-16: references first, then assemblies by distance; ties go by id."""
    by = F.desc("mash_distance") if descending else F.asc("mash_distance")
    rest = distances.select((F.row_number().over(Window.orderBy(by, "assembly_id")) + len(references)).cast("long").alias("order"), "assembly_id")
    fixed = distances.sparkSession.createDataFrame([(i + 1, r) for i, r in enumerate(references)], "order long, assembly_id string")
    return fixed.unionByName(rest)


def evidence_warnings(df: DataFrame) -> DataFrame:
    """FLT-14: fixed limits on a rescue's evidence."""
    limits = ((F.col("allele_reads") < 5, "LOW_ALLELE_READS"), (F.col("allele_fraction") < 0.10, "LOW_ALLELE_FRACTION"), (F.col("reads") > 100000, "MANY_READS"), (F.col("contigs") > 10000, "MANY_CONTIGS"), (F.col("coverage") < 0.80, "LOW_COVERAGE"))
    return df.withColumn("warnings", join_reasons(*limits))
