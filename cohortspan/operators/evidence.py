"""Read evidence for alleles: hits on graph edges, fragments, molecules, calls and carriers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import canonical_edge, fragment_name, path_edges, path_tokens
from .intervals import merge_intervals
from .kernels import PanelScan, pack_kmers, unpack_kmers


def qualified(min_mapq: int) -> Column:
    return F.col("mapq").between(min_mapq, 254) & ~F.col("is_secondary") & (F.col("path") != "*") & (F.col("block") > 0)


def edge_traversals(aln: DataFrame, targets: DataFrame, min_mapq: int = 5, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each traversal of a target edge in either direction, with the columns `keep` of its alignment. Targets: target, allele, feature, edge."""
    rows = aln.filter(qualified(min_mapq)).select("sample_id", "target", *keep, fragment_name(F.col("read_name")).alias("fragment"), F.explode(path_edges(path_tokens(F.col("path")))).alias("_edge"))
    wanted = targets.select("target", "allele", "feature", canonical_edge(F.col("edge")).alias("_edge")).distinct()
    return rows.withColumn("_edge", canonical_edge(F.col("_edge"))).join(wanted, ["target", "_edge"]).select("sample_id", "target", "fragment", "allele", "feature", *keep)


def edge_hits(aln: DataFrame, targets: DataFrame, min_mapq: int = 5) -> DataFrame:
    """JN-18: (keys of both, fragment, allele, feature): the different `edge_traversals`."""
    return edge_traversals(aln, targets, min_mapq).distinct()


def node_interval_hits(aln: DataFrame, intervals: DataFrame) -> DataFrame:
    """JN-18: aligned node pieces that overlap target intervals. Aligned: fragment, node_id, start, end_; intervals: node_id, allele, t_start, t_end."""
    joined = aln.join(intervals, "node_id").filter((F.col("start") < F.col("t_end")) & (F.col("t_start") < F.col("end_")))
    return joined.select("fragment", "allele", "node_id", F.greatest("start", "t_start").alias("start"), F.least("end_", "t_end").alias("end_"))


def fragment_support(hits: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-30: distinct fragments on the left and right junction, the reference and the insertion. A fragment with reference and junction support conflicts and counts for neither."""
    has = lambda f: F.bool_or(F.col("feature") == f)
    per = hits.groupBy(*keys, "fragment").agg(has("left").alias("l"), has("right").alias("r"), has("reference").alias("f"), has("insertion").alias("i"))
    per = per.withColumn("x", (F.col("l") | F.col("r")) & F.col("f"))
    clean = lambda c: F.count_if(F.col(c) & ~F.col("x"))
    return per.groupBy(*keys).agg(clean("l").alias("left_fragments"), clean("r").alias("right_fragments"), clean("f").alias("reference_fragments"), F.count_if("i").alias("insertion_fragments"), F.count_if("x").alias("conflicting_fragments"), F.count(F.lit(1)).alias("locus_fragments"))


def classify_allele_evidence(df: DataFrame, min_junction: int = 3, min_ref: int = 3) -> DataFrame:
    """FLT-16."""
    left, right, ref = F.col("left_fragments"), F.col("right_fragments"), F.col("reference_fragments")
    both = F.least(left, right) >= min_junction
    call = (
        F.when(F.col("conflicting_fragments") >= min(min_junction, min_ref), "CONFLICTING")
        .when(both & (ref >= min_ref), "HET_LIKE")
        .when(both, "ALT_SUPPORTED")
        .when((ref >= min_ref) & (left < min_junction) & (right < min_junction), "REF_SUPPORTED")
        .when(F.greatest(left, right) >= min_junction, "CONFLICTING")
        .otherwise("NO_DECISION")
    )
    return df.withColumn("call", call)


def apply_measurement_lock(evidence: DataFrame, locks: DataFrame) -> DataFrame:
    """FLT-17: carrier state under the lock row of the same graph, locus and allele. Without a usable lock NOT_LOCKED."""
    rows = evidence.join(locks, ["graph_id", "locus_id", "allele_id"], "left")
    enough = F.col("depth") >= F.col("min_depth")
    two_sided = F.least("left_support", "right_support") >= F.col("min_alt")
    state = (
        F.when(F.coalesce(F.col("technical_status"), F.lit("")) != "PASS", "NOT_LOCKED")
        .when(F.col("depth").isNull() | F.col("mapping_ambiguity").isNull() | (F.col("mapping_ambiguity") > F.col("max_mapping_ambiguity")), "NO_CALL")
        .when(~enough, "NO_CALL")
        .when(two_sided, "ALT_SUPPORTED")
        .when((F.col("left_support") == 0) & (F.col("right_support") == 0) & (F.col("reference_support") >= F.col("min_ref")), "REF_SUPPORTED")
        .otherwise("NO_CALL")
    )
    return rows.withColumn("carrier_state", state)


def assign_molecules(obs: DataFrame, assignments: DataFrame) -> DataFrame:
    """JN-19: molecule of each fragment; conflicting assignments get status CONFLICT, missing ones UNASSIGNED."""
    one = assignments.groupBy("library_id", "fragment").agg(F.min("molecule_id").alias("molecule_id"), F.count_distinct("molecule_id").alias("_n"))
    joined = obs.join(one, ["library_id", "fragment"], "left")
    return joined.withColumn("molecule_status", F.when(F.col("_n").isNull(), "UNASSIGNED").when(F.col("_n") > 1, "CONFLICT").otherwise("ASSIGNED")).drop("_n")


def molecule_support(pieces: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-31: molecules and depth: each molecule's union of covered bases over the union of target bases. Pieces: molecule_id, node_id, start, end_."""
    covered = merge_intervals(pieces, [*keys, "molecule_id", "node_id"]).groupBy(*keys, "molecule_id").agg(F.sum(F.col("end_") - F.col("start")).alias("bp"))
    per = covered.groupBy(*keys).agg(F.count(F.lit(1)).alias("molecules"), F.sum("bp").alias("covered_bp"))
    length = merge_intervals(targets, [*keys, "node_id"]).groupBy(*keys).agg(F.sum(F.col("end_") - F.col("start")).alias("target_bp"))
    return length.join(per, keys, "left").fillna(0, ["molecules", "covered_bp"]).withColumn("depth", F.when(F.col("target_bp") > 0, F.col("covered_bp") / F.col("target_bp")))


def anchored_edges(edits: DataFrame, anchor: int) -> DataFrame:
    """AGG-32: edges inside a run of exact edits with at least `anchor` exact bases on both sides. Edits: read_id, step, node, exact, length, new_node."""
    own = Window.partitionBy("read_id").orderBy("step")
    island = F.sum(F.when(F.col("exact"), 0).otherwise(1)).over(own.rowsBetween(Window.unboundedPreceding, 0))
    runs = edits.withColumn("_run", island).filter("exact")
    run = Window.partitionBy("read_id", "_run").orderBy("step")
    before = F.coalesce(F.sum("length").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("length").over(Window.partitionBy("read_id", "_run")) - before
    rows = runs.withColumns({"_before": before, "_after": after, "_from": F.lag("node").over(run)})
    return rows.filter(F.col("new_node") & F.col("_from").isNotNull() & (F.col("_before") >= anchor) & (F.col("_after") >= anchor)).select("read_id", F.col("_from").alias("edge_from"), F.col("node").alias("edge_to"))


def carrier_summary(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-33: attempted, callable, carriers, no-calls, frequency (null if nobody is callable)."""
    carrier, call = F.col("carrier_state") == "ALT_SUPPORTED", F.col("carrier_state").isin("ALT_SUPPORTED", "REF_SUPPORTED")
    g = evidence.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempted"), F.count_if(call).alias("callable"), F.count_if(carrier).alias("carriers"), F.count_if(~call).alias("no_call"))
    return g.withColumn("carrier_frequency", F.when(F.col("callable") > 0, F.col("carriers") / F.col("callable")))


def carrier_matrix(evidence: DataFrame, people: list[str]) -> DataFrame:
    """AGG-34: allele rows, one column a person: 1, 0 or `.`. Above some thousand people use the long form."""
    value = F.when(F.col("carrier_state") == "ALT_SUPPORTED", "1").when(F.col("carrier_state") == "REF_SUPPORTED", "0").otherwise(".")
    return evidence.withColumn("v", value).groupBy("allele_id").pivot("person_id", people).agg(F.first("v")).fillna(".")


def path_support(gaf: DataFrame, targets: DataFrame, min_mapq: int = 5) -> DataFrame:
    """AGG-50: paths over left, right and reference node pairs in any direction. Targets: target, left_pair, right_pair, reference_pair as sorted `a|b`."""
    tokens = F.transform(path_tokens(F.col("path")), lambda t: F.substring(t, 2, 1 << 30))
    pairs = F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda t, i: F.array_join(F.array_sort(F.array(t, F.get(tokens, i + 1))), "|"))
    rows = gaf.filter(qualified(min_mapq)).withColumn("_pairs", pairs).join(targets, "target")
    has = lambda c: F.count_if(F.array_contains("_pairs", F.col(c)))
    return rows.groupBy("sample_id", "target").agg(has("left_pair").alias("left"), has("right_pair").alias("right"), has("reference_pair").alias("reference"))


def pilot_call(df: DataFrame, min_junction: int = 2, min_reference: int = 2) -> DataFrame:
    """FLT-23: call, allele balance and concordance with the expected allele (insertion_present, insertion_absent or blinded). Rows: left, right, reference, expected. REF needs both junctions without any read."""
    left, right, ref = F.col("left"), F.col("right"), F.col("reference")
    both, seen = (left >= min_junction) & (right >= min_junction), ref >= min_reference
    call = F.when(both & seen, "ALT_and_reference_supported").when(both, "ALT_supported").when(seen & (left == 0) & (right == 0), "reference_supported").otherwise("no_call")
    rows = df.withColumns({"pilot_call": call, "allele_balance": F.when(left + right + ref > 0, (left + right) / (left + right + 2 * ref))})
    alt = F.col("pilot_call").startswith("ALT")
    agrees = F.when(F.col("expected") == "insertion_present", alt).when(F.col("expected") == "insertion_absent", ~alt)
    match = F.when(F.col("expected") == "blinded", "blinded").when(F.col("pilot_call") == "no_call", "no_call").when(agrees, "concordant").when(~agrees, "discordant").otherwise("unknown_expectation")
    return rows.withColumn("concordance", match)


def target_agreement(evidence: DataFrame) -> DataFrame:
    """AGG-46."""
    g = evidence.groupBy("sample_id").agg(F.count(F.lit(1)).alias("targets"), F.count_distinct("call").alias("calls"))
    return g.withColumn("agreement", F.when(F.col("targets") == 1, "SINGLE").when(F.col("calls") == 1, "AGREE").otherwise("DISAGREE"))


def call_agreement(evidence: DataFrame, left: str, right: str) -> DataFrame:
    """AGG-52: 2x2 counts of ALT-like and REF calls of two targets over samples called in both."""
    kind = F.when(F.col("call").isin("ALT_SUPPORTED", "HET_LIKE"), "ALT").when(F.col("call") == "REF_SUPPORTED", "REF")
    rows = evidence.withColumn("k", kind).filter("k is not null")
    a = rows.filter(F.col("target") == left).select("sample_id", F.col("k").alias("left_call"))
    b = rows.filter(F.col("target") == right).select("sample_id", F.col("k").alias("right_call"))
    return a.join(b, "sample_id").groupBy("left_call", "right_call").agg(F.count(F.lit(1)).alias("samples"))


def seed_read_support(paf: DataFrame, keys: list[str], min_mapq: int = 20, min_aligned: int = 1000, max_discordance: int = 30) -> DataFrame:
    """AGG-49: distinct reads selected, spanning both anchors, and spanning with at most `max_discordance` discordant bases.

    Aligned length counts on the target. Rows: read_name, tstart, tend, mapq, is_secondary, left_anchor, right_anchor, discordance (SCL-22).
    """
    ok = (F.col("mapq") >= min_mapq) & (F.col("tend") - F.col("tstart") >= min_aligned) & ~F.col("is_secondary")
    spans = ok & (F.col("tstart") <= F.greatest("left_anchor", F.lit(0))) & (F.col("tend") >= F.col("right_anchor"))
    n = lambda c: F.count_distinct(F.when(c, F.col("read_name")))
    return paf.groupBy(*keys).agg(n(ok).alias("selected"), n(spans).alias("spanning"), n(spans & (F.col("discordance") <= max_discordance)).alias("supporting"))


def validate_concordance(panel: DataFrame, people: DataFrame, adjudication: DataFrame, calls: DataFrame) -> DataFrame:
    """JN-21: per validation set and scope: attempted, evaluable, concordant and no-call cells of people x panel.

    A cell is evaluable if its adjudication is resolved and its short-read call is callable. Scope `nonreference_union`
    keeps evaluable cells where either side carries the allele. Panel: allele_id (a short list); people: person_id;
    adjudication: person_id, allele_id, status, truth, validation_set; calls: person_id, allele_id, callable, short_call.
    Cells without an adjudication belong to no validation set. The grid is the result's definition: its size is people
    times panel, and both joins on it are by (person_id, allele_id).
    """
    cell = ["person_id", "allele_id"]
    rows = panel.select("allele_id").crossJoin(people.select("person_id")).join(adjudication, cell).join(calls, cell, "left")
    evaluable = F.col("status").isin("RESOLVED_CARRIER", "RESOLVED_GENOTYPE") & F.coalesce(F.col("callable"), F.lit(False))
    union = evaluable & ((F.col("truth") == "ALT_SUPPORTED") | (F.col("short_call") == "ALT_SUPPORTED"))
    same = F.col("truth") == F.col("short_call")
    one = rows.groupBy("validation_set").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(evaluable).alias("a"), F.count_if(evaluable & same).alias("b"), F.count_if(union).alias("c"), F.count_if(union & same).alias("d")
    )
    return one.selectExpr("validation_set", "stack(2, 'all_resolved', n, a, b, n - a, 'nonreference_union', n, c, d, n - a) AS (scope, attempted, evaluable, concordant, no_call)")


#: Rows up to which a panel of k-mers goes to every task; a larger one is joined.
PANEL_ROWS = 1_000_000


def count_kmers(reads: DataFrame, panel: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """AGG-41: occurrences of panel k-mers. Panel: kmer, panel_group.

    A panel of up to PANEL_ROWS goes to Arrow tasks that scan reads, so k-mers are never exploded; a larger one is joined with them.
    """
    wanted = panel.select("kmer", "panel_group").filter(F.length("kmer") == k).distinct()
    if wanted.limit(PANEL_ROWS + 1).count() > PANEL_ROWS:
        starts = F.sequence(F.lit(1), F.length("seq") - k + 1)
        each = reads.filter(F.length("seq") >= k).select(*keys, F.explode(F.transform(starts, lambda i: F.substring(F.col("seq"), i, F.lit(k)))).alias("kmer"))
        return each.join(wanted, "kmer").groupBy(*keys, "panel_group").agg(F.count(F.lit(1)).alias("hits"))
    rows = wanted.orderBy("kmer", "panel_group").collect()
    shared = reads.sparkSession.sparkContext.broadcast(([r["kmer"] for r in rows], [r["panel_group"] for r in rows]))
    types = {f.name: f.dataType.simpleString() for f in reads.schema}

    def run(batches):
        kmers_, groups = shared.value
        scan = PanelScan(kmers_, groups, k)
        for pdf in batches:
            row, group, n = scan.count(pdf["seq"].fillna("").tolist())
            out = pdf[keys].iloc[row].reset_index(drop=True)
            yield out.assign(panel_group=group, n=n)

    schema = ", ".join(f"{c} {types[c]}" for c in keys) + ", panel_group string, n long"
    return reads.select(*keys, "seq").mapInPandas(run, schema).groupBy(*keys, "panel_group").agg(F.sum("n").alias("hits"))


def kmers(df: DataFrame, k: int = 31) -> DataFrame:
    """SCL-32: distinct k-mers of ACGT only, for short windows. Rows: name, seq."""
    rows = df.filter(F.length("seq") >= k).select("name", F.explode(F.transform(F.sequence(F.lit(1), F.length("seq") - k + 1), lambda i: F.substring(F.col("seq"), i, F.lit(k)))).alias("kmer"))
    return rows.filter(F.col("kmer").rlike(r"^[ACGT]+\z")).distinct()


#: Bases of a text that are packed at a time, and about as many of one name that a task takes.
KMER_BASES = 1 << 22


def distinct_kmers(df: DataFrame, k: int = 31, m: int = 11) -> DataFrame:
    """SCL-32: (name, kmers): how many different k-mers of ACGT the rows of each name hold. Rows: name, seq (of any length).

    A k-mer is never a row. Texts are cut into runs of k-mers that share a part by their minimiser, two bits a base, and runs are what is shuffled, by
    name and part: at most some twelfths of a byte for each k-mer more than the bases. A task unpacks one part of a name at a time into
    64-bit numbers and counts different ones. Names have as many parts as the longest needs for about KMER_BASES each. k is
    at most 31. Rows without a name or text have no k-mers.
    """
    if not 1 <= k <= 31:
        raise ValueError("k is from 1 to 31")
    m = min(m, k)
    rows = df.select("name", "seq").filter("name is not null and seq is not null")
    most = rows.groupBy("name").agg(F.sum(F.length("seq")).alias("n")).agg(F.max("n")).first()[0] or 0
    parts = 1 << min((most // KMER_BASES).bit_length(), 14)
    kind, step = df.schema["name"].dataType.simpleString(), KMER_BASES
    name_type = df.select("name").limit(0).toArrow().schema.field(0).type

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                for at in range(0, len(text), step):  # pieces share k - 1 bases
                    found = pack_kmers(text[at : at + step + k - 1], k, m, parts)
                    if found:
                        names = batch.column(0).take(pa.array([i] * len(found)))
                        yield pa.RecordBatch.from_arrays([names, pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], names=["name", "part", "runs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], name_type), pa.array([len(np.unique(np.concatenate(held)))], pa.int64())], names=["name", "kmers"])

        for batch in batches:
            for name, part, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (name, part) != key:
                    if held:
                        yield close()
                    key, held = (name, part), []
                held.append(unpack_kmers(runs, k))
                if len(held) > 64:
                    held = [np.unique(np.concatenate(held))]
        if held:
            yield close()

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.mapInArrow(pack, f"name {kind}, part int, runs binary").repartition(tasks, "name", "part").sortWithinPartitions("name", "part")
    return packed.mapInArrow(count, f"name {kind}, kmers long").groupBy("name").agg(F.sum("kmers").alias("kmers"))
