"""Paired comparisons between mapping targets and between builds."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import parse_truth_name
from .intervals import _islands
from .kernels import sign_flip


def unpivot(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    return df.select(*keys, *(F.col(m).cast("double").alias(m) for m in metrics)).unpivot(keys, metrics, "metric", "value")


def paired_contrasts(metrics: DataFrame, pairs: list[tuple[str, str]], columns: list[str], sample: str = "sample_id", target: str = "target") -> DataFrame:
    """JN-22: value(right) - value(left) of each sample and metric; BLOCKED where a side or value is missing."""
    long = unpivot(metrics, [sample, target], columns)
    table = metrics.sparkSession.createDataFrame(pairs, "left_target string, right_target string")
    grid = metrics.select(sample).distinct().crossJoin(F.broadcast(table)).crossJoin(F.broadcast(metrics.sparkSession.createDataFrame([(c,) for c in columns], "metric string")))
    side = lambda name: long.select(sample, F.col(target).alias(f"{name}_target"), "metric", F.col("value").alias(f"{name}_value"))
    joined = grid.join(side("left"), [sample, "left_target", "metric"], "left").join(side("right"), [sample, "right_target", "metric"], "left")
    return joined.select(sample, "left_target", "right_target", "metric", (F.col("right_value") - F.col("left_value")).alias("difference"), F.when(F.col("left_value").isNull() | F.col("right_value").isNull(), "BLOCKED").otherwise("READY").alias("status"))


def stratified_summary(diffs: DataFrame, keys: list[str], strata: list[str], value: str = "difference") -> DataFrame:
    """AGG-37: overall and by each stratum: n, mean, median, min, max and counts of signs, in one pass with grouping sets."""
    names = [*keys, *strata]
    # the id's bits stand for left-out columns, the last stratum lowest
    full = (1 << len(strata)) - 1
    sets = [keys, *([*keys, s] for s in strata)]
    v = F.col(value)
    agg = diffs.groupingSets(sets, *names).agg(
        F.grouping_id().alias("_g"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("minimum"), F.max(v).alias("maximum"), F.count_if(v > 0).alias("positive"), F.count_if(v < 0).alias("negative"), F.count_if(v == 0).alias("tied")
    )
    g = F.col("_g")
    stratum = reduce(lambda c, i: F.when(g == full - (1 << (len(strata) - 1 - i)), strata[i]).otherwise(c), range(len(strata)), F.lit("overall"))
    level = reduce(lambda c, i: F.when(g == full - (1 << (len(strata) - 1 - i)), F.col(strata[i]).cast("string")).otherwise(c), range(len(strata)), F.lit("all"))
    return agg.withColumns({"stratum": stratum, "level": level}).drop("_g", *strata)


def sign_flip_tests(diffs: DataFrame, keys: list[str], value: str = "difference", permutations: int = 10_000, seed: int = 1) -> DataFrame:
    """ST-1: p-value of each group's mean difference; a group holds one number a sample."""
    types = {f.name: f.dataType.simpleString() for f in diffs.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf[value].dropna().to_numpy(float))
        p, exact = sign_flip(values, permutations, seed)
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "pairs": len(values), "p_value": p, "exact": exact}])

    return diffs.select(*keys, value).groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", pairs long, p_value double, exact boolean")


def compare_builds(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """AGG-44: both values, difference and ratio of each key of either side."""
    j = a.select(key, F.col(value).alias("left_value")).join(b.select(key, F.col(value).alias("right_value")), key, "full")
    return j.select(key, "left_value", "right_value", (F.col("right_value") - F.col("left_value")).alias("difference"), F.when(F.col("left_value") != 0, F.col("right_value") / F.col("left_value")).alias("ratio"))


def shared_sites(bubbles: DataFrame, graphs: list[str]) -> DataFrame:
    """AGG-27: graphs that have a site, their number and class: shared_all, <graph>_only or shared_some. Rows: site, graph."""
    g = bubbles.groupBy("site").agg(F.array_sort(F.collect_set("graph")).alias("g"))
    label = F.when(F.size("g") == len(graphs), "shared_all").when(F.size("g") == 1, F.concat(F.get("g", F.lit(0)), F.lit("_only"))).otherwise("shared_some")
    return g.select("site", F.array_join("g", ";").alias("graphs"), F.size("g").cast("long").alias("n_graphs"), label.alias("sharing"))


def simulated_accuracy(aln: DataFrame, keys: list[str], tolerance: int = 10_000) -> DataFrame:
    """JN-25: accuracy of simulated reads against the place in their names (SCL-33).

    The best non-secondary row of a read, by MAPQ and block, is compared; a graph path gives its place as the first
    `chr:start-end` in it, else its first chromosome with path coordinates. Reads whose names tell no place are left out.
    The haplotype is assessable where the path names the sample or the haplotype. Rows: read_name, path, qlen, qstart,
    qend, tstart, tend, matches, block, mapq, is_secondary.
    """
    best = aln.filter(~F.col("is_secondary")).groupBy(*keys, "read_name").agg(F.max_by(F.struct("path", "qlen", "qstart", "qend", "tstart", "tend", "matches", "block"), F.struct("mapq", "block", "path", "tstart", "qstart")).alias("b"))
    b = best.select(*keys, parse_truth_name(F.col("read_name")).alias("t"), "b.*").filter("t IS NOT NULL")
    chromosome = r"chr(?:[0-9]+|X|Y|M)"
    span = rf"(?:CHM13[.#])?({chromosome}):([0-9]+)-([0-9]+)"
    in_graph, spanned = F.col("path").rlike("^[><]"), F.col("path").rlike(span)
    named = F.regexp_extract("path", chromosome, 0)
    chrom = F.when(~in_graph, F.col("path")).when(spanned, F.regexp_extract("path", span, 1)).when(named != "", named).otherwise(F.col("path"))
    place = lambda i, c: F.when(in_graph & spanned, F.regexp_extract("path", span, i).try_cast("bigint")).otherwise(F.col(c))
    bare = lambda c: F.regexp_replace(c, "^chr", "")
    rows = b.withColumns({"_same": bare(chrom) == bare(F.col("t.contig")), "_hit": (place(3, "tend") + tolerance >= F.col("t.start")) & (place(2, "tstart") - tolerance <= F.col("t.end"))})
    sample, hap = F.contains("path", F.col("t.sample")), F.contains("path", F.col("t.haplotype"))
    n = F.count(F.lit(1))
    share = lambda c: F.count_if(c) / n
    return rows.groupBy(*keys).agg(
        n.alias("reads_assessed"), share(F.col("_same")).alias("correct_chromosome_fraction"), share(F.col("_same") & F.col("_hit")).alias("correct_locus_fraction"), share(~(F.col("_same") & F.col("_hit"))).alias("wrong_locus_fraction"),
        F.try_divide(F.count_if(sample & hap), F.count_if(sample | hap)).alias("correct_haplotype_fraction"), F.count_if(sample | hap).alias("haplotype_assessable_reads"),
        F.avg(F.coalesce(F.try_divide("matches", "block"), F.lit(0.0))).alias("mean_identity"), F.avg((F.col("qend") - F.col("qstart")) / F.col("qlen")).alias("mean_aligned_fraction"), F.avg((F.col("qstart") + F.col("qlen") - F.col("qend")) / F.col("qlen")).alias("mean_clipped_fraction"),
    )


def coverage_summary(cov: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-15: breadth and length-weighted depth. Rows: length, covered, depth."""
    return cov.groupBy(*keys).agg((F.sum("covered") / F.sum("length")).alias("breadth"), (F.sum(F.col("depth") * F.col("length")) / F.sum("length")).alias("mean_depth"))


def bubble_match(plans: DataFrame, bubbles: DataFrame, distance: int = 500, width: int = 100_000) -> DataFrame:
    """JN-11: bubbles whose nearer end is at most `distance` from a plan, counted. Plans: event_id, chromosome, position_0; bubbles: bubble_id, chromosome, start, end_.

    A bubble is near the positions around its ends; merged for each bubble, these spans open and close, and a plan counts those open at its position:
    a running sum over the positions of a bin of `width` bases, which starts at the sum of the bins before. No pair is made. Only where an event has
    several plans are their bubbles paired and told apart.
    """
    spans = bubbles.select("bubble_id", "chromosome", F.explode(F.array("start", "end_")).alias("_at")).select("bubble_id", "chromosome", (F.col("_at") - distance).alias("_s"), (F.col("_at") + distance + 1).alias("_e"))
    spans = _islands(spans.filter("_s is not null"), ["chromosome", "bubble_id"], 0).filter("chromosome is not null and bubble_id is not null")
    steps = spans.select("chromosome", F.inline(F.array(F.struct(F.col("_s").alias("_at"), F.lit(1).alias("_step")), F.struct(F.col("_e").alias("_at"), F.lit(-1).alias("_step")))))
    steps = steps.groupBy("chromosome", "_at").agg(F.sum("_step").alias("_step"))
    often = F.count(F.lit(1)).over(Window.partitionBy("event_id")) > 1
    own = plans.select("event_id", "chromosome", "position_0", often.alias("_often"))
    asked = own.filter("not _often").select("chromosome", F.col("position_0").alias("_at"), F.lit(None).cast("long").alias("_step"), "event_id", F.lit(1).alias("_asked"))
    both = steps.select("chromosome", "_at", "_step", F.lit(None).cast(plans.schema["event_id"].dataType).alias("event_id"), F.lit(0).alias("_asked")).unionByName(asked).withColumn("_bin", F.floor(F.col("_at") / width))
    before = Window.partitionBy("chromosome").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = both.groupBy("chromosome", "_bin").agg(F.sum("_step").alias("_sum")).select("chromosome", "_bin", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_open"))
    to = Window.partitionBy("chromosome", "_bin").orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("chromosome").eqNullSafe(F.col("_c")) & F.col("_bin").eqNullSafe(F.col("_b"))
    counted = both.withColumn("_inside", F.coalesce(F.sum("_step").over(to), F.lit(0))).filter("_asked = 1").join(bins.select(F.col("chromosome").alias("_c"), F.col("_bin").alias("_b"), "_open"), same, "left")
    found = counted.select("event_id", F.when(F.col("chromosome").isNull() | F.col("_at").isNull(), 0).otherwise(F.col("_inside") + F.col("_open")).alias("bubbles"))
    many = own.filter("_often")
    left = many.select("event_id", "chromosome", "position_0", F.floor(F.col("position_0") / distance).alias("_bin"))
    right = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_s") / distance), F.floor((F.col("_e") - 1) / distance))))
    pairs = left.join(right, ["chromosome", "_bin"]).filter((F.col("position_0") >= F.col("_s")) & (F.col("position_0") < F.col("_e"))).select("event_id", "bubble_id").distinct()
    return found.unionByName(many.select("event_id").join(pairs.groupBy("event_id").agg(F.count(F.lit(1)).alias("bubbles")), "event_id", "left").fillna(0, ["bubbles"]))
