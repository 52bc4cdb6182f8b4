"""Cohort catalogue of structural variants: clustering of evidence, catalogue rows, ranking and selection."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import has_all, literal_sequence, stable_id
from .components import components, saved
from .intervals import length_compatible
from .kernels import OpenHeads, best_sources, near_clusters

ORDER = ("position_0", "svtype", "svlen", "evidence_id")


_KEYS = ["frame", "chromosome", "svtype"]
_ORDER = [*_KEYS, "position_0", "svlen", "evidence_id"]


def _walk(batches: Iterator[pa.RecordBatch], entered, distance: int, similarity: float, emit: bool, before: dict | None = None) -> Iterator[pa.RecordBatch]:
    """Clusters one range of the sorted rows, entered with the heads that are open before it. Batches start with the columns of the order.

    With `emit`, rows with their heads; else one row that tells where the range starts and which heads are open behind it. With `before`, the heads
    it was entered with the last time, it is read only until the same heads are open either way; then what is behind it stays (a null state).
    """
    part = TaskContext.get().partitionId()
    key, heads, first, last, old, same = None, None, None, None, None, False
    for batch in batches:
        if not batch.num_rows or same:
            continue
        found = []
        columns = batch.columns[: len(_ORDER) + 1]
        for start, stop in _stretches(columns[: len(_KEYS)]):
            own = [c[start].as_py() for c in columns[: len(_KEYS)]]
            if key != own:
                if first is None:
                    first = [own, columns[len(_KEYS)][start].as_py()]
                    heads = OpenHeads(distance, similarity, entered.get(part, ()))
                    old = OpenHeads(distance, similarity, before.get(part, ())) if before is not None else None
                elif old is not None:
                    same = True
                    break
                else:
                    heads = OpenHeads(distance, similarity)
                key = own
            rows = [c.slice(start, stop - start) for c in columns[len(_KEYS) :]]
            last = rows[0][len(rows[0]) - 1].as_py()
            if old is None:
                found.append(heads.heads_of(*rows))
                continue
            for row in zip(*(c.to_pylist() for c in (rows[0], rows[1], rows[3], rows[2])), strict=True):
                last = row[0]
                heads.head(*row)
                old.head(*row)
                if old.heads == heads.heads:
                    same = True
                    break
            if same:
                break
        if emit:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.concat_arrays(found)], names=[*batch.schema.names, "cluster_head"])
    if not emit:
        state = None if same else json.dumps([first, key, last, [h for h in heads.heads if last - h[0] <= distance] if heads else []])
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([state], pa.string())], names=["part", "state"])


def _stretches(keys: list[pa.Array]) -> Iterator[tuple[int, int]]:
    """Where rows of one key start and stop in a sorted batch."""
    n = len(keys[0])
    new = reduce(lambda x, y: x | y, [pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False) for k in keys])
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return zip(cuts[:-1], cuts[1:], strict=True)


def cluster_evidence(evidence: DataFrame, distance: int = 500, similarity: float = 0.7, parts: int | None = None) -> DataFrame:
    """WIN-3: evidence with `cluster_head`: the evidence_id of the first row of its cluster.

    Rows in order of position, length and id join the newest open cluster of their type whose first row is compatible. The rows are sorted
    into `parts` ranges of about the same number of rows, wherever they lie: a dense chromosome or a single position is many ranges.
    All ranges are clustered at once as if no head were open before them; what is open behind each is handed to the next one, and
    ranges that were entered with something else are read again, until the same heads are open as before, and so on until none changes. Every range has then been entered with
    what really is open there, since the first one is; few are ever repeated, because what is open is soon the same whatever was before.
    The driver holds the open heads at the borders only, sequences as digests. Rows go to their range once, with all their columns, and come out of it
    with their heads: select what is needed before. Rows without a frame, chromosome, type,
    position, length or id are clusters of their own.
    """
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _ORDER])
    digest = F.when(F.col("alternate_sequence") != "", F.md5("alternate_sequence")).otherwise("") if "alternate_sequence" in evidence.columns else F.lit("")
    types = dict(evidence.dtypes)
    kind = {c: "bigint" if c in ("position_0", "svlen") else "string" for c in _ORDER}
    names = [*(c if types[c] == kind[c] else f"_{c}" for c in _ORDER), "_digest"]  # a column of the right type goes to its range once
    order = [*(F.col(c) if n == c else F.col(c).cast(kind[c]).alias(n) for c, n in zip(_ORDER, names, strict=False)), F.coalesce(digest, F.lit("")).alias("_digest")]
    others = [c for c in evidence.columns if c not in names]
    parts = parts or int(evidence.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = saved(evidence.filter(placed).select(*order, *others).repartitionByRange(parts, *names).sortWithinPartitions(*names))
    context = evidence.sparkSession.sparkContext

    def behind(entered: dict, before: dict | None, which: list[int] | None) -> dict:
        own = ranges if which is None else ranges.filter(F.spark_partition_id().isin(which))
        shared = context.broadcast((entered, before))
        run = lambda it: _walk(it, shared.value[0], distance, similarity, False, shared.value[1])
        rows_ = own.select(names).mapInArrow(run, "part int, state string").filter("state is not null").collect()  # a row a range
        return {r["part"]: json.loads(r["state"]) for r in rows_ if which is None or r["part"] in which}

    entered: dict[int, list] = {}
    left = behind(entered, None, None)
    while True:
        changed, open_, key, before = [], [], None, {}
        for part in sorted(left):
            first, last_key, _, heads = left[part]
            if first is None:
                continue  # a range without rows hands on what it gets
            wanted = [h for h in open_ if first[1] - h[0] <= distance] if key == first[0] else []
            if wanted != entered.get(part, []):
                before[part] = entered.get(part, [])
                entered[part] = wanted
                changed.append(part)
            open_, key = heads, last_key
        if not changed:
            break
        left |= behind(entered, before, changed)
    shared = context.broadcast(entered)
    types = T.StructType([*ranges.schema.fields, T.StructField("cluster_head", T.StringType())])
    rows = ranges.mapInArrow(lambda it: _walk(it, shared.value, distance, similarity, True), types)
    alone = evidence.filter(~placed).withColumn("cluster_head", F.col("evidence_id").cast("string"))
    return rows.select(*evidence.columns, "cluster_head").unionByName(alone)


def number_all(df: DataFrame, order: list, name: str) -> DataFrame:
    """`df` with `name`: 1, 2, ... over the whole table in this order.

    Rows are sorted into ranges; a range starts where the counts of those before it end, and a row's place in its range comes from its id there.
    """
    ranged = saved(df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order))
    placed = ranged.withColumns({"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(F.broadcast(counts.select("_part", before.alias("_before"))), "_part").withColumn(name, F.col("_before") + F.col("_nth") + 1).drop("_part", "_nth", "_before")


def _join_set(col: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.collect_set(col), lambda x: x != "")), ";")


#: Columns of evidence rows that a catalogue shows and that a source may lack.
_OPTIONAL = {"sex_chromosome_status": "string", "end_0": "bigint", "alternate_sequence": "string", "graph_segment": "string", "segment_offset_0": "bigint", "haplotype": "string"}


def catalog_rows(clustered: DataFrame) -> DataFrame:
    """AGG-24 with WIN-4: one row for each cluster that has graph evidence from an assembly outside the graph; ids hold the cluster's ordinal.

    The representative is the surest, then longest, then first row of that evidence. Lists are sets in order, joined by `;`: a cluster's rows lie in one range
    or a few, so its sets are gathered there first and only these are shuffled, by cluster; lists that nobody reads are never made. The ordinal counts clusters in the order of their first rows, over ranges (`number_all`). Null and
    empty values are in no list.
    """
    cluster = ["frame", "chromosome", "cluster_head"]
    clustered = clustered.withColumns({c: F.lit(None).cast(t) for c, t in _OPTIONAL.items() if c not in clustered.columns})
    graph = F.col("discovery_method") == "graph_residual"
    found, control, linear = graph & ~F.col("graph_member"), graph & F.col("graph_member"), ~graph
    shown = ["position_0", "end_0", "svtype", "svlen", "alternate_sequence", "graph_segment", "segment_offset_0"]
    best = F.struct((~F.col("confidence_tier").isin("HIGH_CONFIDENCE", "CALLER_PASS")).alias("weak"), (-F.col("svlen")).alias("neg"), F.col("evidence_id"), *(F.col(c) for c in shown))
    sample, assembly = F.col("sample_id"), F.col("assembly_id")
    carrier = F.when((sample != "") & (F.col("haplotype") != ""), F.concat_ws(":", sample, "haplotype"))
    lists = {
        "carrier_assemblies": F.when(found, assembly), "carrier_haplotypes": F.when(found, carrier), "carrier_samples": F.when(found, sample), "graph_member_control_assemblies": F.when(control, assembly),
        "linear_supporting_samples": F.when(linear, sample), "discovery_methods": F.col("discovery_method"), "caller_support": F.col("caller"), "assembly_qc_tiers": F.when(found, F.col("qc_tier")),
        "sex_chromosome_status": F.col("sex_chromosome_status"), "evidence_ids": F.col("evidence_id"),
    }
    own = lambda c: F.array_sort(F.collect_set(F.when(c.cast("string") != "", c.cast("string"))))
    rows = clustered.groupBy(*cluster).agg(
        F.min(F.when(found, best)).alias("r"),
        F.min(F.struct("position_0", "svtype", "svlen", "evidence_id")).alias("first"),
        F.bool_or(control).alias("controlled"), F.bool_or(found & (F.col("confidence_tier") == "HIGH_CONFIDENCE")).alias("high"), F.bool_or(linear & (F.col("confidence_tier") == "CALLER_PASS")).alias("passed"),
        F.count(F.lit(1)).alias("evidence_count"), *(own(c).alias(f"_{name}") for name, c in lists.items()),
    ).filter("r is not null")
    numbered = number_all(rows, ["frame", "chromosome", "first"], "ordinal")
    samples, tiers = F.size("_carrier_samples"), F.col("_assembly_qc_tiers")
    poor = (F.size(tiers) > 0) & (F.size(F.array_except(tiers, F.array(F.lit("fragmented_rescue"), F.lit("not_recommended")))) == 0)
    confidence = F.when(F.col("controlled") | poor, "UNCERTAIN").when(F.col("high") & (F.col("passed") | (samples >= 2)), "HIGH").when(F.col("high"), "MEDIUM").otherwise("UNCERTAIN")
    validation = F.when(F.col("controlled"), "GRAPH_MEMBER_CONTROL_OVERLAP").when(poor, "PENDING_HIFI").when(F.col("passed"), "LINEAR_CALLER_SUPPORTED").otherwise("ASSEMBLY_ONLY_REVIEW")
    text = lambda name: F.array_join(f"_{name}", ";").alias(name)
    size = lambda name, alias: F.size(f"_{name}").cast("long").alias(alias)
    optional = lambda name: F.coalesce(F.col(f"r.{name}").cast("string"), F.lit(""))
    return numbered.select(
        stable_id("PSV_", "sha1", 16, "|", F.col("frame"), F.col("chromosome"), F.col("r.position_0"), F.col("r.svtype"), F.col("r.svlen"), F.col("ordinal")).alias("event_id"),
        "ordinal", "frame", F.col("frame").alias("coordinate_system"), "chromosome", text("sex_chromosome_status"), "r.position_0", "r.end_0", "r.svtype", "r.svlen", F.lit("").alias("reference_allele"), optional("alternate_sequence").alias("alternate_allele"),
        optional("graph_segment").alias("graph_segment"), "r.segment_offset_0", text("carrier_assemblies"), text("carrier_haplotypes"), text("carrier_samples"), size("carrier_assemblies", "carrier_assembly_count"), size("carrier_samples", "independent_sample_count"),
        text("graph_member_control_assemblies"), size("graph_member_control_assemblies", "graph_member_control_count"), text("linear_supporting_samples"), size("linear_supporting_samples", "linear_supporting_sample_count"), text("discovery_methods"), text("caller_support"),
        text("assembly_qc_tiers"), F.lit("RESIDUAL_TO_FROZEN_GRAPH").alias("graph_representation_status"), validation.alias("validation_status"), confidence.alias("confidence"), text("evidence_ids"), "evidence_count",
    )


def sample_tier(manifest: DataFrame) -> DataFrame:
    """AGG-25."""
    return manifest.groupBy("sample_id").agg(_join_set(F.col("qc_tier")).alias("tiers"), F.max(F.col("graph_member").cast("int")).cast("boolean").alias("any_member"))


def sample_candidates(catalog: DataFrame, limit: int = 25) -> DataFrame:
    """AGG-26: per carrier sample: counts by confidence and type as k=v lists, and the `limit` most useful event ids.

    Event ids are ranked with a row number, so a sample's rows are cut to `limit` before they are gathered.
    """
    catalog = saved(catalog)  # four aggregates read it
    rows = catalog.select("event_id", "confidence", "svtype", "validation_status", F.explode(F.split("carrier_samples", ";")).alias("sample_id")).filter("sample_id <> ''")

    def tally(col: str) -> DataFrame:
        n = rows.groupBy("sample_id", col).agg(F.count(F.lit(1)).alias("n"))
        return n.groupBy("sample_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col(col), F.col("n").cast("string")))), ";").alias(f"by_{col}"))

    order = Window.partitionBy("sample_id").orderBy(F.col("validation_status") != "PENDING_HIFI", F.col("confidence") != "HIGH", "event_id")
    top = rows.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= limit).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("_nth", "event_id"))).alias("t"))
    sums = rows.groupBy("sample_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("confidence") == "HIGH").alias("high"))
    joined = reduce(lambda a, b: a.join(b, "sample_id"), [tally("confidence"), tally("svtype"), top], sums)
    return joined.withColumn("top_events", F.array_join("t.event_id", ";")).drop("t")


def recommend(samples: DataFrame, callable_limit: float = 0.85, validation: int = 50, control: int = 20) -> DataFrame:
    """TOP-1: all blind-spot samples, the best `validation` others with candidates, the best `control` of the rest; one global rank.

    Rows: sample_id, min_callable, uncallable, candidates. A cohort's sample list is small; each pool is one ordered window.
    """
    nth = lambda *order: F.row_number().over(Window.orderBy(*order))
    blind = samples.filter(F.col("min_callable") < callable_limit).withColumn("tier", F.lit("P1_BLIND_SPOT"))
    rest = samples.join(blind.select("sample_id"), "sample_id", "left_anti")
    chosen = rest.filter("candidates > 0").withColumn("_n", nth(F.desc("candidates"), "min_callable", "sample_id")).filter(F.col("_n") <= validation).drop("_n").withColumn("tier", F.lit("P2_VALIDATION"))
    left = rest.join(chosen.select("sample_id"), "sample_id", "left_anti")
    controls = left.withColumn("_n", nth(F.desc("min_callable"), "candidates", "sample_id")).filter(F.col("_n") <= control).drop("_n").withColumn("tier", F.lit("P3_CONTROL"))
    return blind.unionByName(chosen).unionByName(controls).withColumn("request_rank", nth("tier", F.desc("uncallable"), "min_callable", F.desc("candidates"), "sample_id"))


def select_events(catalog: DataFrame, max_events: int = 100, required: list[str] | None = None) -> DataFrame:
    """TOP-3: the first `max_events` by samples, linear support and length; ties at the cut prefer the larger id. Shown with the smaller id first."""
    rows = catalog.filter(has_all(F.col("discovery_methods"), required)) if required else catalog
    cut = rows.orderBy(F.desc("independent_sample_count"), F.desc("linear_supporting_sample_count"), F.desc("svlen"), F.desc("event_id")).limit(max_events)
    return cut.withColumn("selection_rank", F.row_number().over(Window.orderBy(F.desc("independent_sample_count"), F.desc("linear_supporting_sample_count"), F.desc("svlen"), "event_id")))


def select_panel(candidates: DataFrame, difficult: int, genic: int, size: int) -> DataFrame:
    """TOP-4: quotas of difficult and genic loci first, then the best of the rest."""

    def best(pool: DataFrame, n: int, reason: str) -> DataFrame:
        return pool.withColumn("_n", F.row_number().over(Window.orderBy("rank_key", "event_id"))).filter(F.col("_n") <= n).drop("_n").withColumn("reason", F.lit(reason))

    hard = best(candidates.filter("difficult"), difficult, "DIFFICULT")
    rest = candidates.join(hard.select("event_id"), "event_id", "left_anti")
    genes = best(rest.filter("genic"), genic, "GENIC")
    rest = rest.join(genes.select("event_id"), "event_id", "left_anti")
    return hard.unionByName(genes).unionByName(best(rest, max(size - difficult - genic, 0), "RANKED"))


def _best_sources(events: pa.Table, sources: pa.Table, distance: int, similarity: float) -> pa.Table:
    """The places of events in one bin that have a source, with it. Both hold a row a place."""
    number = lambda c: pc.fill_null(c, 0).to_numpy()
    ids = sources.column("_id").combine_chunks()
    nth = np.empty(len(ids), np.int64)
    nth[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
    count, chosen, least, apart = best_sources(
        (number(events.column("_p")), number(events.column("_l")), pc.is_null(events.column("_l")).to_numpy()),
        (*(number(sources.column(c)) for c in ("_p", "_l")), pc.is_null(sources.column("_l")).to_numpy(), number(sources.column("_tier")), number(sources.column("_n")), nth),
        distance, similarity,
    )
    have = pa.array(np.flatnonzero(chosen >= 0))
    which = pa.array(chosen[chosen >= 0])
    far, gap, n = least[chosen >= 0], apart[chosen >= 0], count[chosen >= 0]
    mine, its = events.take(have), sources.take(which)
    columns = [mine.column(c) for c in _PLACE] + [its.column(c) for c in ("_tier", "_id", "_p", "_l")]
    return pa.table([*columns, pa.array(far), pa.array(gap, mask=gap < 0), pa.array(n)], names=[*_PLACE, "_tier", "_id", "_op", "_ol", "_far", "_gap", "_n"])


_PLACE = ["frame", "chromosome", "svtype", "_bin", "_p", "_l"]


def choose_sources(events: DataFrame, candidates: DataFrame, distance: int = 500, similarity: float = 0.7) -> DataFrame:
    """JN-10: the best source of each event: high tier, near, alike in length, high MAPQ, then the smallest id, with the number of its sources.

    Both sides go to bins of many times `distance` bases (sources near a border to both), where places are told apart: rows of
    one place, type and length have the same sources. A bin's sources are counted and chosen without making pairs (`kernels.best_sources`), so work and
    shuffle grow with the rows, not with how many of them lie near each other. `similarity` is from 0 to 1, whole numbers are positions and lengths.
    """
    width, place = 200 * max(distance, 1), _PLACE
    cell = place[:4]
    at, length = F.col("position_0").cast("long"), F.col("svlen").cast("long")
    marked = candidates.filter(at.isNotNull()).select(*cell[:3], at.alias("_p"), length.alias("_l"), F.when(F.col("confidence_tier").isNull(), 0).when(F.col("confidence_tier") == "HIGH_CONFIDENCE", 1).otherwise(2).alias("_tier"), F.struct(F.col("evidence_id").alias("id")).alias("_id"))
    around = marked.withColumn("_bin", F.explode(F.sequence(F.floor((F.col("_p") - distance) / width), F.floor((F.col("_p") + distance) / width))))
    sources = around.repartition(*cell).groupBy(*place, "_tier").agg(F.min("_id").getField("id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    asked = events.filter(at.isNotNull()).select(*cell[:3], at.alias("_p"), length.alias("_l"), "event_id").withColumn("_bin", F.floor(F.col("_p") / width))
    types = {**dict(asked.dtypes), **dict(candidates.select(F.col("evidence_id").alias("_id")).dtypes)}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in place), "_tier int", f"_id {types['_id']}", "_op long, _ol long, _far long, _gap long, _n long"])
    run = lambda e, s: _best_sources(e, s, distance, similarity)
    best = asked.select(*place).distinct().groupBy(*cell).cogroup(sources.groupBy(*cell)).applyInArrow(run, schema)
    named = best.select(*(F.col(c).alias(f"_{c}") for c in place), "_tier", "_id", "_op", "_ol", "_far", "_gap", "_n")
    met = asked.join(named, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "_l" else F.col(c) == F.col(f"_{c}") for c in place]))
    first = F.min_by(F.struct(F.col("_id").alias("other_evidence_id"), F.col("_op").alias("other_position_0"), F.col("_ol").alias("other_svlen")), F.struct(F.nullif("_tier", F.lit(0)), "_far", "_gap", "_id"))
    return met.groupBy("event_id").agg(first.alias("s"), F.sum("_n").alias("sources")).select("event_id", "sources", "s.*")


def account_evidence(catalog: DataFrame, evidence: DataFrame) -> DataFrame:
    """JN-17: evidence rows with the event that lists them and CONFLICT, COVERED or UNMAPPED. Catalog: event_id, evidence_ids (array)."""
    listed = catalog.select("event_id", F.explode("evidence_ids").alias("evidence_id")).groupBy("evidence_id").agg(F.min("event_id").alias("event_id"), F.max("event_id").alias("_last"))
    joined = evidence.join(listed, "evidence_id", "left")
    return joined.withColumn("account", F.when(F.col("event_id") < F.col("_last"), "CONFLICT").when(F.col("event_id").isNotNull(), "COVERED").otherwise("UNMAPPED")).drop("_last")


def _fits(batches: Iterator[pa.RecordBatch], at_least: float) -> Iterator[pa.RecordBatch]:
    """The names of the pairs of sequences of which the first, read against the second, matches well enough."""
    for batch in batches:
        keep = []
        for x, y in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
            matcher = SequenceMatcher(None, x, y)
            keep.append(matcher.real_quick_ratio() >= at_least and matcher.quick_ratio() >= at_least and matcher.ratio() >= at_least)
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["q", "_q"]).filter(pa.array(keep, pa.bool_()))


#: Nodes that one task clusters by itself, about.
TASK_NODES = 50_000


def _near(nodes: pa.Table, distance: int, similarity: float) -> pa.Table:
    """Each node of a range with the least node of its cluster there."""
    number = lambda c: nodes.column(c).to_numpy()
    told = nodes.column("q").combine_chunks().dictionary_encode()
    empty = pc.equal(told.dictionary, "").to_numpy(zero_copy_only=False)
    q = np.where(empty, 0, np.arange(1, len(empty) + 1))[told.indices.to_numpy()]
    cluster = near_clusters(number("p"), number("l"), q, number("bin"), number("band"), distance, similarity)
    ids = number("id")
    least = np.full(int(cluster.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, cluster, ids)
    return pa.table([pa.array(ids), pa.array(least[cluster]), nodes.column("own")], names=["a", "b", "own"])


def transitive_links(nodes: DataFrame, distance: int, length_sim: float, seq_sim: float) -> DataFrame:
    """Edges (a, b, own) that connect all nodes (id, chromosome, svtype, position_0, len, seq, min_id, max_id) which chains of like pairs connect.

    Lengths are cut into bands inside which all are alike, positions into bins inside which all are near. Nodes of one sequence, or without one, are alike
    wherever place and length are. Neighbouring bins are dealt to ranges of about TASK_NODES nodes, each with the bin behind it, and a range clusters these
    nodes by itself (`kernels.near_clusters`): an edge with `own` leads from each node to the cluster of its own range, which is named after its least node,
    one without it to that of a range that only borders on it.
    Different sequences are compared once for each pair of them that meets; only nodes of two sequences that are alike are compared by pairs, of
    which one edge for each node and cell is kept, to the cluster of the other. So edges grow with the nodes, not with pairs of them.
    """
    width = max(distance, 1)
    if length_sim <= 0:
        band = F.lit(0)
    elif length_sim >= 1:
        band = F.col("len")
    else:
        band = F.when(F.col("len") > 0, F.floor(F.log("len") / -math.log(length_sim))).otherwise(-2)
    where = ["chromosome", "svtype"]
    cell = [*where, "q", "band", "bin"]
    own = F.when(F.length("seq") <= 64, F.col("seq")).otherwise(F.concat(F.lit("#"), F.sha2("seq", 256)))  # stands for the sequence
    named = nodes.withColumn("q", own)
    placed = named.withColumns({"n": F.length("seq"), "band": band.cast("long"), "bin": F.floor(F.col("position_0") / width)}).drop("seq")
    around = lambda c, by: F.explode(F.transform(F.array(*(F.lit(i) for i in by)), lambda i: F.col(c) + i))
    ratio = F.when(F.greatest("len", "_len") > 0, F.least("len", "_len") / F.greatest("len", "_len")).otherwise(1.0)
    like = (F.abs(F.col("position_0") - F.col("_p")) <= distance) & (ratio >= length_sim)
    along = Window.partitionBy(*where).orderBy("bin")
    held = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = placed.groupBy(*where, "bin").agg(F.count(F.lit(1)).alias("_n")).select(*where, "bin", F.floor(held / TASK_NODES).alias("range"))
    borders = (F.lag("bin").over(along) == F.col("bin") - 1) & (F.lag("range").over(along) < F.col("range"))
    in_range = lambda at, own: F.array(F.struct(at.alias("range"), F.lit(own).alias("own")))
    both = F.concat(in_range(F.col("range"), True), F.when(borders, in_range(F.lag("range").over(along), False)).otherwise(F.array().cast("array<struct<range:bigint,own:boolean>>")))
    dealt = placed.join(counted.select(*where, "bin", both.alias("_r")), [*where, "bin"]).select(*where, "id", F.col("position_0").cast("long").alias("p"), F.col("len").cast("long").alias("l"), "q", "band", "bin", F.inline("_r"))
    by_range = dealt.groupBy(*where, "range")
    near = saved(by_range.applyInArrow(lambda t: _near(t, distance, length_sim), "a long, b long, own boolean"))
    # different sequences: those whose cells meet, compared once in each order
    told = placed.filter("q <> ''")
    beside = lambda *columns: told.select(*where, around("band", (-1, 0, 1)).alias("band"), around("bin", (-1, 0, 1)).alias("bin"), F.col("q").alias("_q"), *columns)
    able = (F.col("q") != F.col("_q")) & (2 * F.least("n", "_n") / (F.col("n") + F.col("_n")) >= seq_sim)
    met = saved(told.select(*cell, "n").distinct().join(beside(F.col("n").alias("_n")).distinct(), [*where, "band", "bin"]).filter(able).select(*cell, "_q"))
    texts = named.filter("q <> ''").groupBy("q").agg(F.first("seq").alias("seq"))
    two = met.select("q", "_q").distinct().join(texts, "q").join(texts.select(F.col("q").alias("_q"), F.col("seq").alias("_seq")), "_q").select("q", "_q", "seq", "_seq")
    fit = two.mapInArrow(lambda it: _fits(it, seq_sim), "q string, _q string")
    # the later row is read against the earlier one; a pair stands here in both orders
    later = (F.col("position_0") > F.col("_p")) | ((F.col("position_0") == F.col("_p")) & (F.col("max_id") > F.col("_min")))
    others = beside(F.col("band").alias("_band"), F.col("bin").alias("_bin"), F.col("position_0").alias("_p"), F.col("len").alias("_len"), F.col("id").alias("b"), F.col("min_id").alias("_min"))
    pairs = told.join(met.join(fit, ["q", "_q"]), cell).join(others, [*where, "band", "bin", "_q"]).filter(later & like)
    alike = pairs.groupBy(*where, "band", "bin", "_q", "id", "_band", "_bin").agg(F.min("b").alias("_b")).select(F.col("id").alias("a"), "_b")
    home = near.filter("own").select(F.col("a").alias("_b"), "b")
    return near.union(alike.join(home, "_b").select("a", "b", F.lit(False)))


def cluster_transitive(catalog: DataFrame, distance: int = 500, length_sim: float = 0.7, seq_sim: float = 0.8) -> DataFrame:
    """GR-3: (event_id, cluster_id): pairs alike in place, length and sequence, chained. The id comes from the cluster's last row in order of position and event_id.

    Rows that agree in place, length and sequence are one node. Ranges of nodes are clustered by themselves (`transitive_links`); `components` puts together only what
    is at their borders, or alike without being equal. Rows without an anchor keep an empty cluster id.
    """
    anchored = F.col("chromosome").isNotNull() & F.col("svtype").isNotNull() & F.col("position_0").isNotNull() & F.col("svlen").isNotNull()
    sequence = F.coalesce(F.col("alternate_sequence"), F.lit("")) if "alternate_sequence" in catalog.columns else F.lit("")
    rows = catalog.filter(anchored).select("event_id", "chromosome", "svtype", "position_0", F.abs("svlen").alias("len"), sequence.alias("seq"))
    at = ["chromosome", "svtype", "position_0", "len", "seq"]
    nodes = saved(rows.groupBy(*at).agg(F.min("event_id").alias("min_id"), F.max("event_id").alias("max_id")).withColumn("id", F.monotonically_increasing_id()))
    edges = transitive_links(nodes, distance, length_sim, seq_sim)
    home = edges.filter("own").select(F.col("a").alias("id"), F.col("b").alias("part"))
    roots = components(edges.filter("not own").join(home, F.col("a") == F.col("id")).select(F.col("part").alias("a"), "b"))
    named = nodes.join(home, "id").join(roots, F.col("part") == F.col("node"), "left").withColumn("root", F.coalesce("root", "part"))
    last = named.groupBy("root").agg(F.max(F.struct("position_0", "max_id")).alias("_last"))
    named = named.join(last, "root").select(*at, F.concat(F.lit("SVC_"), F.substring(F.sha2(F.col("_last.max_id").cast("string"), 256), 1, 12)).alias("cluster_id"))
    found = rows.join(named, at).select("event_id", "cluster_id")
    return found.unionByName(catalog.filter(~anchored).select("event_id", F.lit("").alias("cluster_id")))


def exclude_contigs(df: DataFrame, default: str, per_source: dict[str, str] | None = None, source: str = "caller") -> DataFrame:
    """FLT-8: rows whose chromosome does not match the pattern as a whole; a source's own pattern replaces the default."""
    keep = ~F.col("chromosome").rlike(f"^(?:{default})$")
    for name, pattern in (per_source or {}).items():
        keep = F.when(F.col(source) == name, ~F.col("chromosome").rlike(f"^(?:{pattern})$")).otherwise(keep)
    return df.filter(keep)


def filter_sv_size(df: DataFrame, minimum: int = 50) -> DataFrame:
    """FLT-9: breakends, translocations and inversions stay at any size."""
    return df.filter((F.col("svlen") >= minimum) | F.col("svtype").isin("BND", "TRA", "CTX", "INV"))


def coordinate_frame(df: DataFrame, sample: str = "CHM13") -> DataFrame:
    """SCL-25: rank 0 is the reference frame; other ranks are GRAPH with chromosome `source|SRrank`."""
    rank0 = F.col("source_rank") == 0
    label = F.coalesce(F.concat(F.col("stable_source"), F.lit("|SR"), F.col("source_rank").cast("string")), F.col("graph_segment"))
    position = F.coalesce("stable_position_0", "segment_offset_0")
    return df.withColumns({"frame": F.when(rank0, sample).otherwise("GRAPH"), "chromosome": F.when(rank0, F.col("stable_source")).otherwise(label), "position_0": F.when(position.isNull(), F.raise_error(F.lit("event without coordinate"))).otherwise(position)})


def coordinate_qc(df: DataFrame, min_sv_size: int = 50, max_unresolved: float = 0.01) -> DataFrame:
    """FLT-11: one row: events of size, resolved, unresolved fraction, PASS or FAIL."""
    own = df.filter(F.col("svlen") >= min_sv_size)
    one = own.agg(F.count(F.lit(1)).alias("events"), F.count("position_0").alias("resolved"))
    share = F.when(F.col("events") > 0, 1 - F.col("resolved") / F.col("events")).otherwise(0.0)
    return one.withColumn("unresolved_fraction", share).withColumn("status", F.when(F.col("unresolved_fraction") <= max_unresolved, "PASS").otherwise("FAIL"))


def compatible(a: Column, b: Column, similarity: float = 0.7) -> Column:
    return length_compatible(a, b, similarity)


def multiset_delta(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """SET-3: records that one version has more often than the other, with their other columns: change NEW or MISSING."""
    if set(old.columns) == set(new.columns) == set(keys):
        return _surplus(old, new, keys)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    a, b = old.withColumn("_nth", nth), new.withColumn("_nth", nth)
    on = [*keys, "_nth"]
    return b.join(a, on, "left_anti").withColumn("change", F.lit("NEW")).unionByName(a.join(b, on, "left_anti").withColumn("change", F.lit("MISSING"))).drop("_nth")


#: Rows that one step of `_surplus` makes of a count.
_REPEATS = 1 << 16


def _surplus(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`multiset_delta` of records that are nothing but their key: equal ones are counted, not ordered, and what one version has more is made of the difference."""
    counts = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_new")).join(old.groupBy(*keys).agg(F.count(F.lit(1)).alias("_old")), keys, "full")
    more = F.coalesce("_new", F.lit(0)) - F.coalesce("_old", F.lit(0))
    spread = counts.withColumn("_more", more).filter("_more <> 0").withColumn("_from", F.explode(F.sequence(F.lit(1), F.abs("_more"), F.lit(_REPEATS))))
    each = F.explode(F.sequence("_from", F.least(F.abs("_more"), F.col("_from") + _REPEATS - 1)))
    return spread.select(*keys, F.when(F.col("_more") > 0, "NEW").otherwise("MISSING").alias("change"), each.alias("_nth")).drop("_nth")


def plan_rescues(events: DataFrame, flank: int = 50_000, min_flank: int = 20_000) -> DataFrame:
    """FLT-22: seed interval of an event on its source contig, clipped, with status by precedence. Rows: source_contig, contig_length, path, reads_ready, query_position_0, svlen."""
    start = F.greatest(F.col("query_position_0") - flank, F.lit(0))
    end = F.least(F.col("query_position_0") + F.col("svlen") + flank, F.col("contig_length"))
    rows = events.withColumns({"seed_start": start, "seed_end": end, "left_flank": F.col("query_position_0") - start, "right_flank": end - F.col("query_position_0") - F.col("svlen")})
    status = F.when(F.col("source_contig").isNull(), "NO_MATCHING_SOURCE").when(F.col("path").isNull(), "MISSING_ASSEMBLY_PATH").when(~F.col("reads_ready"), "WAITING_FOR_HIFI").when(F.least("left_flank", "right_flank") < min_flank, "SOURCE_NEAR_CONTIG_END").otherwise("READY")
    return rows.withColumn("plan_status", status)


def normalize_catalog(sources: list[tuple[str, DataFrame, dict[str, str]]]) -> DataFrame:
    """GR-7: catalogues of two kinds in one schema, with an id of its own for every row but the first of each id.

    A source is (kind, rows, facts). Kind `provisional`: row, event_id, coordinate_system, chromosome, position_0, end_0, svtype, svlen,
    alternate_allele, graph_segment, segment_offset_0, carrier_samples, discovery_methods, confidence, graph_representation_status.
    Kind `vcf`: row and the columns of `read_vcf`; every alternate allele is a row. `row` (long) orders a source's rows; facts may name
    coordinate_system, source_graph, source_sample, discovery_method, graph_membership_status.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    parts = []
    for number, (kind, df, facts) in enumerate(sources):
        if kind == "provisional":
            inserted = F.when((F.col("svtype") == "INS") & literal_sequence(F.col("alternate_allele")), F.upper("alternate_allele")).otherwise(F.lit(""))
            rows = df.select(
                "row", F.lit(1).alias("alt"), F.upper(text("coordinate_system")).alias("_frame"), text("coordinate_system").alias("_spelled"), text("chromosome").alias("_chrom"), text("position_0").alias("_start"), text("end_0").alias("_end"),
                text("graph_segment").alias("graph_node"), text("segment_offset_0").alias("graph_offset_0"), text("svtype").alias("svtype"), text("svlen").alias("svlen"), inserted.alias("inserted_sequence"), text("event_id").alias("source_event_id"), F.lit(True).alias("_named"),
                text("carrier_samples").alias("source_sample"), text("discovery_methods").alias("discovery_method"), F.coalesce("confidence", F.lit("unresolved")).alias("breakpoint_confidence"), F.coalesce("graph_representation_status", F.lit("unknown")).alias("graph_membership_status"), F.lit("not_insertion").alias("_else"),
            )
        elif kind == "vcf":
            one = df.select("*", F.posexplode("alts").alias("_k", "_alt")).withColumn("_type", F.coalesce(F.col("info")["SVTYPE"], F.when(F.length("_alt") > F.length("ref"), "INS").otherwise("DEL")))
            shown = F.when(F.col("_alt").startswith(F.col("ref")), F.substring("_alt", F.length("ref") + 1, F.length("_alt"))).otherwise(F.col("_alt"))
            inserted = F.when((F.col("_type") == "INS") & literal_sequence(shown), F.upper(shown)).otherwise(F.lit(""))
            end = F.coalesce(F.col("info")["END"].cast("bigint"), F.col("pos0") + 1 + F.greatest(F.length("ref"), F.lit(1)))
            length = F.split(F.coalesce(F.col("info")["SVLEN"], F.abs(F.length("_alt") - F.length("ref")).cast("string")), ",")[0]
            name = F.when(F.col("id") != ".", F.col("id")).otherwise(F.concat(F.lit("record_"), F.col("row").cast("string"), F.lit("_ALT"), (F.col("_k") + 1).cast("string")))
            frame = facts.get("coordinate_system", "unprojected").upper()
            rows = one.select(
                "row", (F.col("_k") + 1).alias("alt"), F.lit(frame).alias("_frame"), F.lit(frame).alias("_spelled"), F.col("chromosome").alias("_chrom"), F.col("pos0").cast("string").alias("_start"), end.cast("string").alias("_end"),
                F.lit("").alias("graph_node"), F.lit("").alias("graph_offset_0"), F.col("_type").alias("svtype"), length.alias("svlen"), inserted.alias("inserted_sequence"), name.alias("source_event_id"), F.lit(False).alias("_named"),
                F.lit(facts.get("source_sample", "")).alias("source_sample"), F.lit(facts.get("discovery_method", "VCF")).alias("discovery_method"), F.col("filter").alias("breakpoint_confidence"), F.lit(facts.get("graph_membership_status", "unknown")).alias("graph_membership_status"), F.lit("symbolic").alias("_else"),
            )
        else:
            raise ValueError(f"unknown kind of catalogue {kind!r}")
        parts.append(rows.withColumns({"_source": F.lit(number), "source_graph": F.lit(facts.get("source_graph", ""))}))
    rows = reduce(DataFrame.unionByName, parts)
    own = stable_id("SV_", "sha256", 16, "\0", *(F.col(c) for c in ("_spelled", "_chrom", "_start", "_end", "svtype", "svlen", "inserted_sequence")))
    rows = rows.withColumn("_id", F.when(F.col("_named") & (F.col("source_event_id") != ""), F.col("source_event_id")).otherwise(own))
    nth = F.row_number().over(Window.partitionBy("_id").orderBy("_source", "row", "alt"))
    again = stable_id("SV_", "sha256", 16, "\0", F.col("_id"), F.col("source_graph"), F.col("source_event_id"))
    at = lambda c, *names: F.when(F.col("_frame").isin(*names), F.col(c)).otherwise(F.lit(""))
    placed = {f"{name.lower()}_{part}": at(c, *names) for name, names in (("CHM13", ("CHM13",)), ("GRCh38", ("GRCH38", "HG38"))) for part, c in (("chrom", "_chrom"), ("start_0", "_start"), ("end_0", "_end"))}
    known = F.col("inserted_sequence") != ""
    return rows.select(
        F.when(nth == 1, F.col("_id")).otherwise(again).alias("stable_event_id"), *(c.alias(n) for n, c in placed.items()), "graph_node", "graph_offset_0", "svtype", "svlen", "inserted_sequence", F.when(known, F.sha2("inserted_sequence", 256)).otherwise("").alias("inserted_sequence_sha256"),
        "source_graph", "source_sample", "discovery_method", "breakpoint_confidence", F.when(known, "sequence_resolved").otherwise(F.concat(F.lit("sequence_unavailable_or_"), F.col("_else"))).alias("sequence_confidence"), "graph_membership_status",
        F.when(F.col("_frame").isin("CHM13", "GRCH38", "HG38"), "projected").otherwise("unprojected_preserved").alias("projection_status"), "source_event_id",
    )
