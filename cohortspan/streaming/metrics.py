"""Running figures over alignment files as they arrive. The same functions run on a batch DataFrame and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evidence import edge_hits, edge_traversals


def mapping_histogram(aln: DataFrame) -> DataFrame:
    """STR-1: counts by sample, target, MAPQ and secondary flag with sums, in update mode: state has a row for each of at most 512 values a target."""
    return aln.groupBy("sample_id", "target", "mapq", "is_secondary").agg(F.count(F.lit(1)).alias("rows"), F.sum("matches").alias("matches"), F.sum("block").alias("block"))


def mapping_figures(histogram: DataFrame) -> DataFrame:
    """Final ratios and the exact median MAPQ from the histogram."""
    primary = histogram.filter(~F.col("is_secondary"))
    return primary.groupBy("sample_id", "target").agg(F.sum("rows").alias("primary"), F.percentile("mapq", 0.5, F.col("rows")).alias("median_mapq"), (F.sum(F.when(F.col("mapq") >= 20, F.col("rows")).otherwise(0)) / F.sum("rows")).alias("mapq20_fraction"))


def stream_fragment_support(aln: DataFrame, targets: DataFrame, min_mapq: int = 5, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """STR-2: distinct fragments by sample, target, allele and feature.

    With `event_time` (a column of the stream) a fragment is remembered until the watermark passes it by `delay`, so state is bounded by
    the fragments of that time beside one row for each group; a fragment whose alignments are farther apart counts again, and
    alignments behind the watermark are left out. Without it every fragment on a target edge is remembered. A batch counts exactly.
    """
    groups = ["sample_id", "target", "allele", "feature"]
    if event_time and aln.isStreaming:
        hits = edge_traversals(aln.withWatermark(event_time, delay), targets, min_mapq, (event_time,)).dropDuplicatesWithinWatermark([*groups, "fragment"])
    else:
        hits = edge_hits(aln, targets, min_mapq)
    return hits.groupBy(*groups).agg(F.count(F.lit(1)).alias("fragments"))
