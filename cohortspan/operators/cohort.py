"""Cohorts: identities, eligibility, memberships, flow counts, strata and samples of people or reads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import join_reasons
from .components import running_totals, saved
from .kernels import blake2b_unit


def resolve_identity(reads: DataFrame, aliases: DataFrame) -> DataFrame:
    """JN-14: person of each row by (namespace, alias); RESOLVED, UNRESOLVED or CONFLICT where an alias has several persons."""
    one = aliases.groupBy("namespace", "alias").agg(F.min("person_id").alias("person_id"), F.count_distinct("person_id").alias("_n"))
    joined = reads.join(one, ["namespace", "alias"], "left")
    status = F.when(F.col("_n").isNull(), "UNRESOLVED").when(F.col("_n") > 1, "CONFLICT").otherwise("RESOLVED")
    return joined.withColumn("identity_status", status).withColumn("person_id", F.when(F.col("_n") == 1, F.col("person_id"))).drop("_n")


def join_phenotypes(source: DataFrame, crosswalk: DataFrame, samples: DataFrame) -> DataFrame:
    """JN-15: clinical rows with their person and filled values; two known values that differ give CONFLICT; unmapped rows stay."""
    rows = source.join(crosswalk, "source_id", "left").join(samples.select("person_id", F.col("phenotype").alias("_known")), "person_id", "left")
    a, b = F.col("phenotype"), F.col("_known")
    status = F.when(F.col("person_id").isNull(), "UNMAPPED").when(a.isNotNull() & b.isNotNull() & (a != b), "CONFLICT").otherwise("MAPPED")
    return rows.withColumns({"mapping_status": status, "phenotype": F.coalesce(b, a)}).drop("_known")


def membership_audit(samples: DataFrame, graphs: DataFrame, members: DataFrame) -> DataFrame:
    """JN-16: every sample x graph (both small lists) with membership and FAIL where a held-out sample is in a headline graph. Unknown membership is not absence."""
    known = members.select("graph").distinct().withColumn("_known", F.lit(True))
    grid = samples.crossJoin(F.broadcast(graphs)).join(members.withColumn("_member", F.lit(True)), ["sample_id", "graph"], "left").join(known, "graph", "left")
    membership = F.when(F.col("_member"), "MEMBER").when(F.col("_known"), "ABSENT").otherwise("UNKNOWN")
    rows = grid.withColumn("membership", membership)
    audit = F.when(F.col("held_out") & F.col("headline") & (F.col("membership") == "MEMBER"), "FAIL").when(F.col("membership") == "UNKNOWN", "UNKNOWN").otherwise("PASS")
    return rows.withColumn("audit", audit).drop("_member", "_known")


def eligibility(samples: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """FLT-18: eligible with reasons; a flag that is not `yes` blocks, and unknown never passes. Rules: column -> (reason if no, reason if unknown)."""
    pairs = [(F.col(c) == "no", no) for c, (no, _) in rules.items()] + [(~F.col(c).isin("yes", "no") | F.col(c).isNull(), unknown) for c, (_, unknown) in rules.items()]
    return samples.withColumn("reasons", join_reasons(*pairs)).withColumn("eligible", F.col("reasons") == "")


def sample_flow(samples: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """AGG-35: cumulative filters with what is left after each and the share of the step before, from one aggregate."""
    condition, aggs = F.lit(True), [F.count(F.lit(1)).alias("n0")]
    for i, (_, c) in enumerate(steps, 1):
        condition = condition & F.coalesce(c, F.lit(False))
        aggs.append(F.count_if(condition).alias(f"n{i}"))
    names = ["all", *(n for n, _ in steps)]
    rows = F.array(*(F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(f"n{i}").alias("samples"), F.col(f"n{max(i - 1, 0)}").alias("denominator")) for i, n in enumerate(names)))
    return samples.agg(*aggs).select(F.inline(rows))


def descriptive_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-36."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def depth_quartiles(cells: DataFrame, depth: str) -> Column:
    """The quartile of a row's depth by its lowest rank, as text. Ranks come from running counts over ranges of depths; four borders are all that rows then need."""
    sizes = cells.groupBy(depth).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(sizes, [F.col(depth).asc_nulls_first()], {"_upto": "_n"})
    quartile = F.ceil(4 * (F.col("_upto") - F.col("_n") + 1) / F.lit(cells.count()))
    borders = ranked.groupBy(quartile.alias("q")).agg(F.max(depth).alias("top"), F.bool_or(F.col(depth).isNull()).alias("missing")).orderBy(F.desc("q")).collect()
    found = F.lit(None).cast("string")
    for r in borders:
        if r["top"] is not None:
            found = F.when(F.col(depth) <= F.lit(r["top"]), str(r["q"])).otherwise(found)
    without = next((str(r["q"]) for r in borders if r["missing"]), None)
    return F.when(F.col(depth).isNull(), F.lit(without)).otherwise(found)


def missingness(cells: DataFrame, value: str, strata: list[str], depth: str) -> DataFrame:
    """AGG-38: share of missing values in each stratum and in each quartile of depth (by lowest rank, cells without a depth first)."""
    rows = cells.withColumn("depth_quartile", depth_quartiles(cells, depth))
    sets = [*strata, "depth_quartile"]
    flat = rows.select(F.col(value).isNull().cast("int").alias("m"), F.explode(F.array(*(F.struct(F.lit(s).alias("stratum"), F.col(s).cast("string").alias("level")) for s in sets))).alias("s"))
    return flat.groupBy("s.stratum", "s.level").agg(F.count(F.lit(1)).alias("cells"), F.sum("m").alias("missing"), F.avg("m").alias("missing_fraction"))


def inclusion_stats(samples: DataFrame, key: str) -> DataFrame:
    """AGG-39: samples, full, partial, excluded and haplotypes kept of each group, with rates. Rows: kept_haplotypes 0, 1 or 2."""
    k = F.col("kept_haplotypes")
    g = samples.groupBy(key).agg(F.count(F.lit(1)).alias("samples"), F.count_if(k == 2).alias("full"), F.count_if(k == 1).alias("partial"), F.count_if(k == 0).alias("excluded"), F.sum(k).alias("haplotypes"))
    return g.withColumns({"full_rate": F.col("full") / F.col("samples"), "haplotype_rate": F.col("haplotypes") / (2 * F.col("samples"))})


def depth_bins(samples: DataFrame, depth: str = "depth", key: str = "sample_id") -> DataFrame:
    """WIN-7: tertiles by 3 * rank against n, ties by id; the sizes differ from ntile's. A sample list is one window."""
    rank, n = F.row_number().over(Window.orderBy(depth, key)) - 1, F.count(F.lit(1)).over(Window.partitionBy())
    return samples.withColumn("depth_bin", F.when(3 * rank < n, "low").when(3 * rank < 2 * n, "medium").otherwise("high"))


def hash_sample(df: DataFrame, name: str, seed: str, fraction) -> DataFrame:
    """SMP-1: rows whose hash of seed and name, as a number in [0, 1), is below `fraction` (a number or a column): the same names at any partitioning. Rows without a name go."""

    @F.pandas_udf("double")
    def unit(names: pd.Series) -> pd.Series:
        return pd.Series([blake2b_unit(seed, n) for n in names], dtype=float)

    return df.filter(F.col(name).isNotNull()).filter(unit(F.col(name).cast("string")) < fraction)


def coverage_sample(reads: DataFrame, keys: list[str], name: str, length: str, seed: str, coverage: float | None, genome_size: int) -> tuple[DataFrame, DataFrame]:
    """SMP-1 by coverage: (selected reads, one report row for each of `keys`).

    The fraction is what `coverage` times `genome_size` bases are of all bases, at most 1; without a coverage all reads are taken. A
    group's total comes first, then its reads are taken by `hash_sample`, so nothing is gathered. Bases are
    at most as many as asked for only on average. A name that occurs twice, a group without bases and one of which nothing is taken show in the report's `problem`.
    """
    if coverage is not None and coverage <= 0:
        raise ValueError("a coverage is positive")
    size = F.coalesce(F.col(length), F.lit(0))
    totals = reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_reads"), F.sum(size).cast("long").alias("total_bases"))
    asked = F.col("total_bases") if coverage is None else F.lit(round(coverage * genome_size)).cast("long")
    totals = saved(totals.withColumn("requested_bases", asked).withColumn("sampling_fraction", F.when(F.col("total_bases") > 0, F.least(F.lit(1.0), F.col("requested_bases") / F.col("total_bases"))).otherwise(0.0)))
    joined = reads.join(totals.select(*keys, F.col("sampling_fraction").alias("_fraction")), keys)
    chosen = hash_sample(joined, name, seed, F.col("_fraction")).drop("_fraction")
    taken = chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("selected_reads"), F.sum(size).cast("long").alias("selected_bases"))
    twice = reads.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").groupBy(*keys).agg(F.count(F.lit(1)).alias("_twice"))
    report = totals.join(taken, keys, "left").join(twice, keys, "left").fillna({"selected_reads": 0, "selected_bases": 0})
    problem = F.when(F.col("_twice") > 0, "duplicate read names").when(F.col("total_bases") == 0, "no bases").when(F.col("selected_reads") == 0, "no reads selected").otherwise("")
    return chosen, report.withColumn("problem", problem).drop("_twice")


def affine_sample(df: DataFrame, index: str, total: int, k: int, multiplier: int, offset: int) -> DataFrame:
    """SMP-2: exactly `k` of `total` rows with indices 0..total-1: those whose place under i -> multiplier * i + offset is below k.

    `multiplier` must be coprime to `total`; the inverse is computed once and products are decimals, so none overflows.
    """
    inverse = pow(multiplier, -1, total)
    place = F.pmod((F.col(index).cast("decimal(19,0)") - F.lit(offset).cast("decimal(19,0)")) * F.lit(inverse).cast("decimal(19,0)"), F.lit(total).cast("decimal(38,0)"))
    return df.withColumn("sample_place", place.cast("long")).filter(F.col("sample_place") < k)


def quota_sample(candidates: DataFrame, total: int, seed: str, batch: str = "batch", key: str = "sample_id", coverage: str = "depth", target: float = 30.0) -> DataFrame:
    """SMP-3: quotas of batches by largest remainder, then in each batch those nearest to the target coverage; ties by a seeded hash."""
    sizes = candidates.groupBy(batch).agg(F.count(F.lit(1)).alias("_n"))
    share = F.lit(total) * F.col("_n") / F.sum("_n").over(Window.partitionBy())
    quotas = sizes.withColumn("_share", share).withColumn("_base", F.floor("_share"))
    left = F.lit(total) - F.sum("_base").over(Window.partitionBy())
    extra = F.row_number().over(Window.orderBy(F.desc(F.round(F.col("_share") - F.col("_base"), 9)), batch)) <= left
    quotas = quotas.select(batch, (F.col("_base") + extra.cast("long")).alias("quota"))
    nth = F.row_number().over(Window.partitionBy(batch).orderBy(F.abs(F.col(coverage) - target), F.sha2(F.concat_ws("\0", F.lit(seed), F.col(key)), 256)))
    return candidates.join(F.broadcast(quotas), batch).withColumn("_nth", nth).filter(F.col("_nth") <= F.col("quota")).drop("_nth")


def pair_reads(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """WIN-11: mates by (lane, record index) with PAIRED, NAME_MISMATCH or UNPAIRED. Rows: lane, idx, name."""
    a, b = r1.select("lane", "idx", F.col("name").alias("name_1")), r2.select("lane", "idx", F.col("name").alias("name_2"))
    joined = a.join(b, ["lane", "idx"], "full")
    return joined.withColumn("pair_status", F.when(F.col("name_1").isNull() | F.col("name_2").isNull(), "UNPAIRED").when(F.col("name_1") == F.col("name_2"), "PAIRED").otherwise("NAME_MISMATCH"))


def fastq_totals(reads: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-45."""
    return reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("reads"), F.sum("length").alias("bases"), F.count_distinct("lane").alias("lanes"))


def dedupe_sequences(df: DataFrame, key: str, sequence: str, order: str) -> DataFrame:
    """WIN-10: the first row of each sequence is INCLUDED, later ones are DUPLICATE_SEQUENCE and name the first. Sequences travel as hashes."""
    hashed = df.select(key, order, F.sha2(F.upper(sequence), 256).alias("sequence_sha256"))
    own = Window.partitionBy("sequence_sha256").orderBy(order, key)
    rows = hashed.withColumns({"_nth": F.row_number().over(own), "first_name": F.first(key).over(own)})
    return rows.withColumn("status", F.when(F.col("_nth") == 1, "INCLUDED").otherwise("DUPLICATE_SEQUENCE")).drop("_nth")


def grouped_order(manifest: DataFrame, group: str, order: str, first_rank: int) -> DataFrame:
    """WIN-13: ranks by first appearance of the group, then the order inside it."""
    first = manifest.withColumn("_first", F.min(order).over(Window.partitionBy(group)))
    return first.withColumn("rank", F.row_number().over(Window.orderBy("_first", order)) + first_rank - 1).drop("_first")


def exclusion_ledger(*tables: tuple[str, str, str, DataFrame]) -> DataFrame:
    """AGG-48: rows of all tables that are not callable, in one form, with the source row as JSON (columns in order of name).

    Tables: (name, entity, identifier column, rows). Rows with a `callable` column leave it out where it is `yes`;
    `status` and `reason` are empty where a table has none.
    """
    out = None
    for name, entity, identifier, df in tables:
        kept = df.filter(~F.col("callable").eqNullSafe(F.lit("yes"))) if "callable" in df.columns else df
        text = lambda c, df=df: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
        rows = kept.select(F.lit(name).alias("source_table"), F.lit(entity).alias("entity"), text(identifier).alias("identifier"), text("status").alias("status"), text("reason").alias("reason"), F.to_json(F.struct(*sorted(df.columns))).alias("source_record_json"))
        out = rows if out is None else out.unionByName(rows)
    return out


def status_snapshot(tables: DataFrame) -> DataFrame:
    """AGG-48: state of each stage from its status words. Rows: stage, status (null: the stage has an output without rows of that word, or none), available.

    UNRUN without output; FAILED if any row failed; COMPLETED or SKIPPED if all rows say so; else OUTPUT_AVAILABLE.
    """
    states = F.collect_set(F.when(F.col("available"), F.col("status")))
    only = lambda words: (F.size("_s") > 0) & (F.size(F.array_except("_s", F.array(*map(F.lit, words)))) == 0)
    seen = tables.groupBy("stage").agg(states.alias("_s"), F.max("available").alias("_any"), F.min("available").alias("_all"))
    state = (
        F.when(F.arrays_overlap("_s", F.array(F.lit("FAILED"), F.lit("ERROR"))), "FAILED").when(only(["SKIPPED", "NOT_IMPLEMENTED"]), "SKIPPED")
        .when(only(["COMPLETED", "COMPLETE", "ESTIMATED"]) & F.col("_all"), "COMPLETED").when(F.col("_any"), "OUTPUT_AVAILABLE").otherwise("UNRUN")
    )
    return seen.select("stage", state.alias("state"))


def representation_matrix(alleles: DataFrame, resources: DataFrame, hits: DataFrame) -> DataFrame:
    """JN-20: allele x resource (three resources) with hits, and whether the allele is in none. A resource without review stays UNDECIDED."""
    grid = alleles.select("allele_id").crossJoin(F.broadcast(resources))
    counted = grid.join(hits.groupBy("allele_id", "resource").agg(F.count(F.lit(1)).alias("hits")), ["allele_id", "resource"], "left").fillna(0, ["hits"])
    rows = counted.withColumn("status", F.when(~F.col("reviewed"), "UNDECIDED").when(F.col("hits") > 0, "REPRESENTED").otherwise("NOT_REPRESENTED"))
    return rows.withColumn("absent_everywhere", F.min((F.col("status") == "NOT_REPRESENTED").cast("int")).over(Window.partitionBy("allele_id")) == 1)


def paired_samples(assemblies: DataFrame) -> DataFrame:
    """JN-32: every sample with whether it has exactly the assemblies hap1 and hap2. Rows: sample, haplotype."""
    return assemblies.groupBy("sample").agg(F.sort_array(F.collect_set("haplotype")).alias("_h")).select("sample", (F.col("_h") == F.array(F.lit("hap1"), F.lit("hap2"))).alias("paired"))


def call_manifest(assemblies: DataFrame, references: list[str], callers: list[str], sex_mode: str, sex_contigs: str, par_aware: tuple[str, ...] = ("dipcall",)) -> DataFrame:
    """JN-32: paired samples x references x callers. Sex contigs are excluded for all callers where `sex_mode` is autosomes_only, else for those that know no pseudoautosomal regions."""
    grid = paired_samples(assemblies).filter("paired").select("sample", F.explode(F.array(*map(F.lit, references))).alias("coordinate_system"))
    grid = grid.withColumn("caller", F.explode(F.array(*map(F.lit, callers))))
    keeps = F.col("caller").isin(*par_aware) if sex_mode != "autosomes_only" else F.lit(False)
    return grid.withColumn("exclude_contig_regex", F.when(keeps, "").otherwise(sex_contigs))


def carrier_by_group(evidence: DataFrame, samples: DataFrame) -> DataFrame:
    """AGG-53: per allele and independence group of the person: attempted, callable, carriers and no-calls.

    Evidence: person_id, allele_id, callable, carrier_status; samples: person_id, discovery_donor,
    related_to_discovery_donor, analysis_eligible, unrelated_primary (yes, no or unknown).
    """
    donor, related = F.col("discovery_donor"), F.col("related_to_discovery_donor")
    no, yes = (donor == "no") & (related == "no"), (donor == "yes") | (related == "yes")
    primary = (F.col("analysis_eligible") == "yes") & (F.col("unrelated_primary") == "yes")
    group = F.when(no & primary, "independent_primary").when(no, "non_donor_not_primary").when(yes, "discovery_overlap").otherwise("independence_unknown")
    called = F.col("callable") == "yes"
    g = evidence.join(samples.select("person_id", group.alias("independence_group")), "person_id").groupBy("allele_id", "independence_group")
    return g.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(called).alias("callable"), F.count_if(called & (F.col("carrier_status") == "ALT_SUPPORTED")).alias("carriers"), (F.count(F.lit(1)) - F.count_if(called)).alias("no_call"))


def coverage_report(samples: DataFrame, intervals: DataFrame) -> DataFrame:
    """AGG-47: per sample in the order of the inventory: input, represented and excluded bases and intervals; samples without intervals count as 0. Samples: ordinal, sample, input_bases; intervals: sample, start, end_."""
    g = intervals.groupBy("sample").agg(F.sum(F.col("end_") - F.col("start")).alias("represented_bases"), F.count(F.lit(1)).alias("intervals"))
    rows = samples.join(g, "sample", "left").fillna(0, ["represented_bases", "intervals"])
    return rows.select("ordinal", "sample", "input_bases", "represented_bases", (F.col("input_bases") - F.col("represented_bases")).alias("excluded_unaligned_bases"), "intervals").orderBy("ordinal")


def candidate_flow(attempts: DataFrame) -> DataFrame:
    """AGG-55: records, alleles and loci that reach each status."""
    return attempts.groupBy("status").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("allele_id").alias("alleles"), F.count_distinct("locus_id").alias("loci"))
