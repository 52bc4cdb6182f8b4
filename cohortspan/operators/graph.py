"""Sequence graphs as segment and link tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import flip_token, path_tokens, reverse_complement
from .components import components, saved
from .kernels import contract


def rank_tally(segments: DataFrame, links: DataFrame) -> DataFrame:
    """AGG-16: segments, bases and links of each rank that either table has."""
    s = segments.groupBy("sr").agg(F.count(F.lit(1)).alias("segments"), F.sum("ln").alias("bp"))
    return s.join(links.groupBy("sr").agg(F.count(F.lit(1)).alias("links")), "sr", "full").fillna(0, ["segments", "bp", "links"])


def degrees(segments: DataFrame, links: DataFrame) -> DataFrame:
    """AGG-17: degree of every segment; both ends of a link count, so a self-loop counts twice."""
    ends = links.select(F.explode(F.array("left_id", "right_id")).alias("segment_id")).groupBy("segment_id").agg(F.count(F.lit(1)).alias("degree"))
    return segments.join(ends, "segment_id", "left").fillna(0, ["degree"])


def graph_overview(segments: DataFrame, degree: DataFrame) -> DataFrame:
    """AGG-18: metric, value rows. Lower length bins are [low, high); those from 10 kb on are strict and overlap."""
    with_degree = segments.join(degree.select("segment_id", "degree"), "segment_id")
    ref, ln = F.col("sr") == 0, F.col("ln")
    metrics = {
        "segments": F.count(F.lit(1)), "bp": F.sum("ln"), "reference_bp": F.sum(F.when(ref, ln).otherwise(0)), "nonreference_bp": F.sum(F.when(~ref, ln).otherwise(0)), "mean_length": F.avg("ln"),
        "mean_degree": F.avg("degree"), "max_degree": F.max("degree"), "hubs": F.count_if(F.col("degree") >= 4),
        "lt_50": F.count_if(ln < 50), "50_1000": F.count_if((ln >= 50) & (ln < 1000)), "1000_10000": F.count_if((ln >= 1000) & (ln < 10000)), "gt_10kb": F.count_if(ln > 10000), "gt_100kb": F.count_if(ln > 100000),
    }
    # quantiles from running counts over the histogram of lengths, which has a row a length
    sizes = with_degree.groupBy("ln").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    run = sizes.withColumns({"upto": F.sum("n").over(order), "all": F.sum("n").over(Window.partitionBy())})
    # N50: the longest length such that segments of at least it hold half of all bases
    bases = segments.filter("ln > 0").groupBy("ln").agg(F.sum("ln").alias("bp"))
    longer = bases.withColumns({"more": F.sum("bp").over(Window.orderBy(F.desc("ln")).rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("bp").over(Window.partitionBy())})
    n50 = longer.agg(F.max(F.when(2 * F.col("more") >= F.col("all"), F.col("ln"))).cast("double").alias("n50"))

    def quantile(share: float) -> Column:
        place = (F.col("all") - 1) * share
        below, above = (F.min(F.when(F.col("upto") > f(place), F.col("ln"))).cast("double") for f in (F.floor, F.ceil))
        part = F.max(place - F.floor(place))
        return below + (above - below) * part

    shares = {"median_length": 0.5, **{f"length_q{q}": q / 100 for q in (0, 10, 25, 75, 90, 99, 100)}}
    one = with_degree.agg(*(c.cast("double").alias(n) for n, c in metrics.items())).crossJoin(run.agg(*(quantile(x).alias(n) for n, x in shares.items()))).crossJoin(n50)  # one row each
    metrics |= shares | {"n50": 0.5}
    return one.select(F.explode(F.create_map(*[x for n in metrics for x in (F.lit(n), F.col(f"`{n}`"))])).alias("metric", "value"))


def rank_conflicts(segments: DataFrame) -> DataFrame:
    """AGG-19: source names with several ranks, with segments and bases."""
    return segments.groupBy("sn").agg(F.count_distinct("sr").alias("ranks"), F.count(F.lit(1)).alias("segments"), F.sum("ln").alias("bp")).filter("ranks > 1")


def per_chromosome(labelled: DataFrame) -> DataFrame:
    """AGG-20: reference and other bases of each chromosome and the latter per Mb, in canonical order. Rows: chromosome, sr, ln."""
    ref = F.col("sr") == 0
    g = labelled.groupBy("chromosome").agg(F.sum(F.when(ref, F.col("ln")).otherwise(0)).alias("reference_bp"), F.sum(F.when(~ref, F.col("ln")).otherwise(0)).alias("nonreference_bp"))
    number = F.regexp_extract("chromosome", "^chr([0-9]+)$", 1)
    order = F.when(number != "", number.cast("int")).when(F.col("chromosome") == "chrX", 23).when(F.col("chromosome") == "chrY", 24).otherwise(25)
    return g.select("chromosome", "reference_bp", "nonreference_bp", F.when(F.col("reference_bp") > 0, 1e6 * F.col("nonreference_bp") / F.col("reference_bp")).alias("nonreference_per_mb"), order.alias("chromosome_order"))


def graph_inventory(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """AGG-21: segments, links, embedded paths and segment bases from rows record_type (S, L, P, W), length."""
    kind = lambda k: F.count_if(F.col("record_type") == k)
    bases = F.coalesce(F.sum(F.when(F.col("record_type") == "S", F.col("length"))), F.lit(0))
    return records.groupBy(*(keys or [])).agg(kind("S").alias("segments"), kind("L").alias("links"), F.count_if(F.col("record_type").isin("P", "W")).alias("paths"), bases.alias("segment_bp"))


def inventory_delta(source: DataFrame, final: DataFrame) -> DataFrame:
    """AGG-21: metric, value rows of both inventories and their difference, from one pass over each graph."""
    both = graph_inventory(source.withColumn("side", F.lit("source")).unionByName(final.withColumn("side", F.lit("final"))), ["side"])
    names = ["segments", "links", "paths", "segment_bp"]
    sides = both.agg(*(F.coalesce(F.max(F.when(F.col("side") == s, F.col(n))), F.lit(0)).alias(f"{s}_{n}") for s in ("source", "final") for n in names))
    wide = sides.select("*", *((F.col(f"final_{n}") - F.col(f"source_{n}")).alias(f"delta_{n}") for n in names))
    return wide.unpivot([], wide.columns, "metric", "value")


def growth_curve(tally: DataFrame) -> DataFrame:
    """WIN-1: new bases by rank, cumulative with and without the first donor. One row for each rank."""
    own = Window.orderBy("sr").rowsBetween(Window.unboundedPreceding, 0)
    rows = tally.filter("sr > 0")
    return rows.select("sr", F.col("bp").alias("novel_bp"), F.sum("bp").over(own).alias("cumulative_bp"), F.sum(F.when(F.col("sr") > 1, F.col("bp")).otherwise(0)).over(own).alias("cumulative_without_first_bp"))


def growth_fit(curve: DataFrame) -> DataFrame:
    """ST-8: power law of cumulative bases by rank, with three points at least, and the mean of the last tenth."""
    x, y = F.log("sr"), F.log("cumulative_bp")
    last = F.col("sr") > F.floor(F.lit(0.9) * F.max("sr").over(Window.partitionBy()))
    return curve.withColumn("_last", last).agg(F.count(F.lit(1)).alias("points"), F.when(F.count(F.lit(1)) >= 3, F.regr_slope(y, x)).alias("exponent"), F.when(F.count(F.lit(1)) >= 3, F.exp(F.regr_intercept(y, x))).alias("scale"), F.avg(F.when(F.col("_last"), F.col("novel_bp"))).alias("last_decile_mean_bp"))


def count_inversions(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """WIN-2: falls of `value` from one row to the next."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_step", step).groupBy(*keys).agg(F.count_if(F.col("_step") < 0).alias("inversions"), F.count(F.lit(1)).alias("rows"))


def assign_reference_chromosome(segments: DataFrame, links: DataFrame) -> DataFrame:
    """GR-1: every segment with its component and the chromosome that has most reference bases in it; ties go to the smaller name."""
    named = components(links, "left_id", "right_id").withColumnsRenamed({"node": "segment_id", "root": "component"})
    rows = segments.join(named, "segment_id", "left").withColumn("component", F.coalesce("component", "segment_id"))
    bases = rows.filter("sr = 0").groupBy("component", F.col("sn").alias("chromosome")).agg(F.sum("ln").alias("bp"))
    label = bases.groupBy("component").agg(F.min_by("chromosome", F.struct(-F.col("bp"), F.col("chromosome"))).alias("chromosome"))
    return rows.join(label, "component", "left")


def anchor_status(labelled: DataFrame, new: DataFrame, links: DataFrame) -> DataFrame:
    """GR-2: for new segments, how many reference chromosomes their links' other ends belong to: ANCHORED, UNANCHORED or CROSS_REFERENCE_COMPONENT."""
    both = links.select(F.col("left_id").alias("segment_id"), F.col("right_id").alias("other")).unionByName(links.select(F.col("right_id").alias("segment_id"), F.col("left_id").alias("other")))
    anchors = both.join(labelled.select(F.col("segment_id").alias("other"), "chromosome"), "other").groupBy("segment_id").agg(F.count_distinct("chromosome").alias("anchors"))
    joined = new.select("segment_id").join(anchors, "segment_id", "left").fillna(0, ["anchors"])
    return joined.withColumn("status", F.when(F.col("anchors") == 0, "UNANCHORED").when(F.col("anchors") == 1, "ANCHORED").otherwise("CROSS_REFERENCE_COMPONENT"))


def integrity_checks(segments: DataFrame, links: DataFrame) -> DataFrame:
    """GR-4: check, observed, status rows: duplicate ids, missing tags, empty segments, dangling link ends, self-loops."""
    s = segments.agg((F.count(F.lit(1)) - F.count_distinct("segment_id")).alias("duplicate_segments"), F.count_if(F.col("sn").isNull() | F.col("sr").isNull()).alias("missing_tags"), F.count_if(F.col("ln") <= 0).alias("empty_segments"))
    ends = links.select(F.explode(F.array("left_id", "right_id")).alias("segment_id"))
    dangling = ends.join(segments.select("segment_id").distinct(), "segment_id", "left_anti").agg(F.count(F.lit(1)).alias("dangling_ends"))
    loops = links.agg(F.count_if(F.col("left_id") == F.col("right_id")).alias("self_loops"))
    one = s.crossJoin(dangling).crossJoin(loops)
    rows = one.select(F.expr("stack(5, 'duplicate_segments', duplicate_segments, 'missing_tags', missing_tags, 'empty_segments', empty_segments, 'dangling_ends', dangling_ends, 'self_loops', self_loops) AS (check, observed)"))
    return rows.withColumn("status", F.when(F.col("observed") == 0, "PASS").when(F.col("check") == "self_loops", "WARN").otherwise("FAIL"))


def locate_on_path(events: DataFrame, segments: DataFrame) -> DataFrame:
    """JN-12: the segment and offset of a position along an oriented path. Events: event_id, path, position.

    A step is a segment id or `name:start-end`. Lengths come from a join, prefix sums from a window over one path; the
    last step also takes the position at its very end; a reverse step counts from its end. An unknown step at or
    before the position leaves the row unresolved (nulls).
    """
    steps = events.select("event_id", "position", F.posexplode(path_tokens(F.col("path"))).alias("step", "token"), F.size(path_tokens(F.col("path"))).alias("_n"))
    steps = steps.withColumns({"_name": F.substring("token", 2, 1 << 30), "_rev": F.col("token").startswith("<")})
    span = r"^(.+):([0-9]+)-([0-9]+)$"
    by_span = F.col("_name").rlike(span)
    joined = steps.join(segments.select(F.col("segment_id").alias("_name"), F.col("ln").alias("_ln")), "_name", "left")
    size = F.when(by_span, F.regexp_extract("_name", span, 3).try_cast("bigint") - F.regexp_extract("_name", span, 2).try_cast("bigint")).otherwise(F.col("_ln"))
    own = Window.partitionBy("event_id").orderBy("step")
    sized = joined.withColumn("_size", size).withColumns({"_before": F.coalesce(F.sum("_size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_unknown": F.count_if(F.col("_size").isNull()).over(own.rowsBetween(Window.unboundedPreceding, 0))})
    local = F.col("position") - F.col("_before")
    inside = (local >= 0) & ((local < F.col("_size")) | ((local == F.col("_size")) & (F.col("step") == F.col("_n") - 1)))
    hit = sized.filter((F.col("_unknown") == 0) & inside)
    first = F.when(by_span, F.regexp_extract("_name", span, 2).try_cast("bigint")).otherwise(F.lit(0))
    offset = first + F.when(F.col("_rev"), F.greatest(F.col("_size") - local - 1, F.lit(0))).otherwise(local)
    found = hit.groupBy("event_id").agg(F.min_by(F.struct(F.when(by_span, F.regexp_extract("_name", span, 1)).otherwise(F.col("_name")).alias("segment"), offset.alias("segment_offset")), "step").alias("f"))
    return events.join(found, "event_id", "left").select(*events.columns, "f.segment", "f.segment_offset")


def dense_ids(nodes: DataFrame) -> DataFrame:
    """WIN-12: (chunk, node_id, dense_id): ids from 1 in the order of (chunk, length of id, id), without gaps over chunks. One row a chunk is ordered globally."""
    own = F.row_number().over(Window.partitionBy("chunk").orderBy(F.length("node_id"), "node_id"))
    counts = nodes.groupBy("chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return nodes.withColumn("_own", own).join(before, "chunk").select("chunk", "node_id", (F.col("_own") + F.col("_before")).alias("dense_id"))


def check_tiling(segments: DataFrame, lengths: DataFrame) -> DataFrame:
    """WIN-15: per reference: starts at 0, contiguous, ends at its length. Segments: name, start, end_; lengths: name, length."""
    gap = F.coalesce(F.lag("end_").over(Window.partitionBy("name").orderBy("start", "end_")), F.lit(0)) != F.col("start")
    g = segments.withColumn("_gap", gap).groupBy("name").agg(F.count_if("_gap").alias("breaks"), F.max("end_").alias("_end"))
    return lengths.join(g, "name", "left").select("name", F.coalesce("breaks", F.lit(0)).alias("breaks"), (F.coalesce("breaks", F.lit(1)) == 0).alias("contiguous"), F.coalesce(F.col("_end") == F.col("length"), F.lit(False)).alias("complete"))


#: Links that one task takes when bridges are sought, about.
TASK_LINKS = 50_000


def physical_links(links: DataFrame) -> DataFrame:
    """Distinct links between node ends: left_id, left_end, right_id, right_end (`left` or `right`), the smaller end first. A link and its reverse are one.

    Links: left_id, right_id and left_forward, right_forward (forward where a column is missing).
    """
    forward = lambda c: F.col(c) if c in links.columns else F.lit(True)
    a = F.struct(F.col("left_id").alias("id"), F.when(forward("left_forward"), "right").otherwise("left").alias("end"))
    b = F.struct(F.col("right_id").alias("id"), F.when(forward("right_forward"), "left").otherwise("right").alias("end"))
    ends = links.filter("left_id is not null and right_id is not null").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    return ends.select(F.col("a.id").alias("left_id"), F.col("a.end").alias("left_end"), F.col("b.id").alias("right_id"), F.col("b.end").alias("right_end"))


def find_bridges(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """GR-5, first part: the physical links whose removal splits their component; parallel links and links of a node with itself are none.

    Links are sorted by node name into ranges of about `task_links`. A range settles what it can by itself and hands on a few edges
    in place of the rest (`kernels.contract`): as many as it has nodes with links elsewhere, at most twice. What ranges hand on is
    cut into at most half as many ranges, until one is left. Names that follow the chromosomes, as graph builders give them,
    have few nodes with links elsewhere; names at random shrink a graph only to two edges a node, and the last task takes that many.
    """
    spark = links.sparkSession
    whole = saved(physical_links(links))
    ids = F.concat_ws("|", "left_id", "left_end", "right_id", "right_end")
    edges = whole.filter("left_id <> right_id").select(ids.alias("edge"), F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    place = F.substring_index("a", "\0", 1)  # nodes that stand for several are named after their first
    parts, steps = 1 << 30, []
    while parts > 1:
        edges = saved(edges)
        parts = min(-(-edges.count() // task_links), parts // 2) or 1
        if parts > 1:
            ranged = saved(edges.repartitionByRange(parts, F.length(place), place)).withColumn("part", F.spark_partition_id())
            ends = ranged.select("part", F.explode(F.array("a", "b")).alias("node")).distinct()
            shared = saved(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node"))
            for c in ("a", "b"):
                ranged = ranged.join(shared.select(F.col("node").alias(c), F.lit(True).alias(f"{c}_shared")), c, "left")
        else:
            ranged = edges.withColumns({"part": F.lit(0), "a_shared": F.lit(None).cast("boolean"), "b_shared": F.lit(None).cast("boolean")})
        step = len(steps)

        def run(pdf: pd.DataFrame, step: int = step) -> pd.DataFrame:
            pdf = pdf.sort_values("edge")
            shared = set(pdf.loc[pdf["a_shared"].notna(), "a"]) | set(pdf.loc[pdf["b_shared"].notna(), "b"])
            sure, rest = contract(list(zip(pdf["edge"], pdf["a"], pdf["b"], strict=True)), shared, f"{step}.{pdf['part'].iloc[0]}")
            rows = [(x, None, None, None) for x in sure] + [(own, e, a, b) for e, a, b, inside in rest for own in inside or [None]]
            return pd.DataFrame(rows, columns=["edge", "into", "a", "b"])

        steps.append(saved(ranged.groupBy("part").applyInPandas(lambda pdf: run(pdf), "edge string, into string, a string, b string")))
        edges = steps[-1].filter("into is not null").select(F.col("into").alias("edge"), "a", "b").distinct()
    found = spark.createDataFrame([], "edge string")
    for rows in reversed(steps):
        own = rows.filter("edge is not null")
        found = own.filter("into is null").select("edge").union(own.join(found.select(F.col("edge").alias("into")), "into", "left_semi").select("edge"))
    return whole.withColumn("edge", ids).join(found, "edge", "left_semi").drop("edge")


def choose_cuts(backbone: DataFrame, links: DataFrame, bridges: DataFrame, chunk_bp: int, slack_bp: int) -> tuple[DataFrame, DataFrame]:
    """GR-5, second part: where to cut. (boundaries, cut links) for a backbone of rows reference, start, end_, segment_id that tile each reference.

    Every multiple of `chunk_bp` inside a reference is a target. Candidates are borders of neighbouring segments whose forward link is a bridge; the nearest
    one (the left one on a tie) is taken if it is at most `slack_bp` away. Candidates are first reduced to the outermost ones
    between two targets, so what is ordered has a row a target. A border without its link is an error when read.
    """
    after = backbone.select("reference", F.col("start").alias("at"), F.col("segment_id").alias("right"))
    borders = backbone.select("reference", F.col("end_").alias("at"), F.col("segment_id").alias("left")).join(after, ["reference", "at"])
    key = lambda a, b: F.least(F.struct(a.alias("id"), F.lit("right").alias("end")), F.struct(b.alias("id"), F.lit("left").alias("end")))
    other = lambda a, b: F.greatest(F.struct(a.alias("id"), F.lit("right").alias("end")), F.struct(b.alias("id"), F.lit("left").alias("end")))
    a, b = key(F.col("left"), F.col("right")), other(F.col("left"), F.col("right"))
    ends = ["left_id", "left_end", "right_id", "right_end"]
    borders = borders.select("reference", "at", a["id"].alias("left_id"), a["end"].alias("left_end"), b["id"].alias("right_id"), b["end"].alias("right_end"))
    known = physical_links(links).withColumn("_known", F.lit(True)).join(bridges.select(*ends).withColumn("_bridge", F.lit(True)), ends, "left")
    checked = borders.join(known, ends, "left").withColumn("_bridge", F.when(F.col("_known").isNull(), F.raise_error(F.concat(F.lit("no forward link at "), "reference", F.lit(":"), F.col("at").cast("string")))).otherwise(F.col("_bridge")))
    candidates = saved(checked.filter("_bridge").select("reference", "at", *ends))
    slot = F.floor(F.col("at") / chunk_bp)  # a candidate on a target is right of it
    outermost = candidates.groupBy("reference", slot.alias("slot")).agg(F.min("at").alias("_lo"), F.max("at").alias("_hi"))
    lengths = backbone.groupBy("reference").agg(F.max("end_").alias("_length"))
    slots = lengths.select("reference", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_length") - 1) / chunk_bp))).alias("slot")).join(outermost, ["reference", "slot"], "left")
    order = Window.partitionBy("reference").orderBy("slot")
    left = F.max("_hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    right = F.min("_lo").over(order.rowsBetween(0, Window.unboundedFollowing))
    target = F.col("slot") * chunk_bp
    placed = slots.withColumns({"target": target, "_l": left, "_r": right}).filter("slot > 0")
    nearest = F.when(F.col("_r").isNull() | (F.col("target") - F.col("_l") <= F.col("_r") - F.col("target")), F.col("_l")).otherwise(F.col("_r"))
    boundaries = placed.withColumn("nearest_safe", nearest).withColumn("distance", F.abs(F.col("nearest_safe") - F.col("target")))
    near = F.coalesce(F.col("distance") <= slack_bp, F.lit(False))
    boundaries = saved(boundaries.select("reference", "target", "nearest_safe", "distance", near.alias("selected"), F.when(near, "bridge").otherwise("no_bridge_within_slack").alias("reason")))
    chosen = boundaries.filter("selected").select("reference", F.col("nearest_safe").alias("at")).distinct()
    return boundaries, candidates.join(chosen, ["reference", "at"]).select(*ends)


def partition_graph(segments: DataFrame, links: DataFrame, backbone: DataFrame, cuts: DataFrame, max_bp: int, max_span: int) -> DataFrame:
    """GR-5, third part: what is left after the cuts: chunk (its smallest segment), reference, start, end_, max_reference_span, seed_bp, nodes, status.

    The status names all limits that a chunk breaks (multiple_references, reference_span_limit, seed_bases_limit) or is PASS.
    """
    ends = ["left_id", "left_end", "right_id", "right_end"]
    rest = physical_links(links).join(cuts.select(*ends), ends, "left_anti")
    named = components(rest, "left_id", "right_id").withColumnsRenamed({"node": "segment_id", "root": "chunk"})
    owned = segments.select("segment_id", "ln").join(named, "segment_id", "left").withColumn("chunk", F.coalesce("chunk", "segment_id"))
    rows = owned.join(backbone.select("segment_id", "reference", "start", "end_"), "segment_id", "left")
    each = rows.groupBy("chunk", "reference").agg(F.sum("ln").alias("_bp"), F.count(F.lit(1)).alias("_n"), F.min("start").alias("_s"), F.max("end_").alias("_e"))
    span = F.coalesce(F.max(F.col("_e") - F.col("_s")), F.lit(0)).cast("long")
    found = each.groupBy("chunk").agg(
        F.array_join(F.array_sort(F.collect_set("reference")), ";").alias("_refs"), F.count("reference").alias("_many"), F.coalesce(F.min("_s"), F.lit(0)).cast("long").alias("start"), F.coalesce(F.max("_e"), F.lit(0)).cast("long").alias("end_"),
        span.alias("max_reference_span"), F.sum("_bp").cast("long").alias("seed_bp"), F.sum("_n").cast("long").alias("nodes"),
    )
    broken = F.concat_ws(",", F.when(F.col("_many") > 1, "multiple_references"), F.when(F.col("max_reference_span") > max_span, "reference_span_limit"), F.when(F.col("seed_bp") > max_bp, "seed_bases_limit"))
    return found.select("chunk", F.when(F.col("_refs") == "", ".").otherwise(F.col("_refs")).alias("reference"), "start", "end_", "max_reference_span", "seed_bp", "nodes", F.when(broken == "", "PASS").otherwise(broken).alias("status"))


def partition_report(chunks: DataFrame, bridges: DataFrame, cuts: DataFrame) -> DataFrame:
    """GR-5, one row: whether the partition is feasible, and its counts. Nothing may be built on one that is not."""
    own = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("status") != "PASS").alias("problems"), F.count_if(F.col("reference") == ".").alias("off_reference_chunks"), F.max("max_reference_span").alias("largest_reference_span"), F.max("seed_bp").alias("largest_seed_bp"))
    counted = own.crossJoin(bridges.agg(F.count(F.lit(1)).alias("bridges"))).crossJoin(cuts.agg(F.count(F.lit(1)).alias("cuts")))  # three rows of one
    return counted.withColumn("feasible", F.col("problems") == 0)


def verify_walks(walks: DataFrame, segments: DataFrame, links: DataFrame) -> DataFrame:
    """GR-6: per walk: steps without a link (in either reading of it), unknown segments, spelled length and SHA-256; reverse steps spell the reverse complement.

    Walks: walk_id, path (`>a<b`), each as long as a chunk; segments: segment_id, seq; links: left_token, right_token.
    """
    steps = walks.select("walk_id", F.posexplode(path_tokens(F.col("path"))).alias("step", "token")).withColumn("segment_id", F.substring("token", 2, 1 << 30))
    next_ = F.lead("token").over(Window.partitionBy("walk_id").orderBy("step"))
    edge = lambda a, b: F.least(F.concat(a, b), F.concat(flip_token(b), flip_token(a)))
    linked = links.select(edge(F.col("left_token"), F.col("right_token")).alias("_edge"), F.lit(True).alias("_link")).distinct()
    joined = steps.withColumn("_next", next_).withColumn("_edge", edge(F.col("token"), F.col("_next"))).join(linked, "_edge", "left").join(segments.select("segment_id", "seq"), "segment_id", "left")
    part = F.when(F.col("token").startswith("<"), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", part.alias("seq")))), lambda s: s["seq"]), "")
    return joined.groupBy("walk_id").agg(F.count_if(F.col("_edge").isNotNull() & F.col("_link").isNull()).alias("missing_links"), F.count_if(F.col("seq").isNull()).alias("unknown_segments"), F.sum(F.length("seq")).cast("long").alias("length"), F.sha2(spelled, 256).alias("sequence_sha256"))


def rename_sources(segments: DataFrame, source_map: DataFrame) -> DataFrame:
    """SCL-35: source names through a map old_name, new_name; names without an entry are an error when read."""
    joined = segments.join(source_map, F.col("sn") == F.col("old_name"), "left")
    return joined.withColumn("sn", F.when(F.col("new_name").isNotNull(), F.col("new_name")).when(F.col("sr") == 0, F.col("sn")).otherwise(F.raise_error(F.concat(F.lit("no source name for "), F.col("sn"))))).drop("old_name", "new_name")


def chunk_sizes(chunks: DataFrame, max_bp: int) -> DataFrame:
    """AGG-42: bases, alignments and haplotypes of each chunk with SEED_ONLY, OVERSIZED or PASS. Rows: chunk, bp, assembly_id (null: none)."""
    g = chunks.groupBy("chunk").agg(F.sum("bp").alias("bp"), F.count("assembly_id").alias("alignments"), F.count_distinct("assembly_id").alias("haplotypes"))
    return g.withColumn("status", F.when(F.col("alignments") == 0, "SEED_ONLY").when(F.col("bp") > max_bp, "OVERSIZED").otherwise("PASS"))


def translate_edges(targets: DataFrame, translation: DataFrame) -> DataFrame:
    """JN-24: oriented segment edges in dense node ids; a segment without translation leaves a null node. Targets: edge_id, left_token, right_token; translation: segment_id, nodes (array), as long as the graph and so never broadcast by hint."""

    def side(token: str, at: int, name: str) -> DataFrame:
        nodes = F.when(F.col(token).startswith("<"), F.reverse("nodes")).otherwise(F.col("nodes"))
        return translation.select(F.col("segment_id").alias(f"_{name}"), "nodes"), F.concat(F.substring(token, 1, 1), F.element_at(nodes, at).cast("string")).alias(name)

    left, left_node = side("left_token", -1, "left_node")
    right, right_node = side("right_token", 1, "right_node")
    rows = targets.join(left, F.substring("left_token", 2, 1 << 30) == F.col("_left_node"), "left").select("*", left_node).drop("nodes", "_left_node")
    return rows.join(right, F.substring("right_token", 2, 1 << 30) == F.col("_right_node"), "left").select("edge_id", "left_token", "right_token", "left_node", right_node)


def is_reference(rank: Column) -> Column:
    return rank == 0
