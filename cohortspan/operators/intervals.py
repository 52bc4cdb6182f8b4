"""Half-open intervals as rows: union, intersection, complement, overlap, nearest and band joins.

Joins on position bin both sides and join on (key, bin), so a chromosome is never one group; windows are keyed by the
finest natural key (contig, read), never by chromosome alone for reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Bases of a bin inside which intervals are put in order; a key's bins go to as many tasks as it has.
UNION_BASES = 1 << 20


def _cut(df: DataFrame, start: Column, end: Column, width: int) -> DataFrame:
    """Rows with `_bin`, `_s` and `_e`: each interval cut at the borders of the bins that it touches. A row without a start or end stays one row."""
    first, last = F.floor(start / width), F.floor(F.greatest(end - 1, start) / width)
    cut = df.withColumns({"_start": start, "_end": end, "_bin": F.explode_outer(F.sequence(first, last))})
    inside = lambda c: F.least(F.greatest(F.col(c), F.col("_bin") * width), (F.col("_bin") + 1) * width)
    return cut.withColumns({"_s": F.when(F.col("_bin").isNull(), F.col("_start")).otherwise(inside("_start")), "_e": F.when(F.col("_bin").isNull() | (F.col("_end") < F.col("_start")), F.col("_end")).otherwise(inside("_end"))}).drop("_start", "_end")


def _islands(df: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """(keys, _s, _e, ...) of rows with `_s` and `_e`, merged where they overlap, abut or lie at most `gap` apart."""
    order = Window.partitionBy(*keys).orderBy("_s", "_e")
    before = F.max("_e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.select(*keys, "_s", "_e", F.when(F.col("_s") <= before + F.lit(gap), 0).otherwise(1).alias("_new"))
    island = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))


def merge_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end_", gap: int = 0, width: int = UNION_BASES) -> DataFrame:
    """AGG-4: (keys, start, end_) of merged intervals. Intervals that abut merge; so do those at most `gap` apart. Empty ones stay.

    Intervals are merged in bins of `width` bases first. Only the first and last one of a bin can go on in another bin: these are
    merged again, two rows a bin at most, so a long key with many intervals is many tasks.
    """
    width = max(width, gap + 1)
    cut = _cut(df.select(*keys, start, end), F.col(start), F.col(end), width)
    own = _islands(cut, [*keys, "_bin"], gap)
    of_bin = Window.partitionBy(*keys, "_bin")
    placed = own.withColumns({"_first": F.min("_island").over(of_bin), "_last": F.max("_island").over(of_bin)})
    at_border = F.col("_island").isin(F.col("_first"), F.col("_last"))
    joined = _islands(placed.filter(at_border).select(*keys, "_s", "_e"), keys, gap)
    columns = [*keys, F.col("_s").alias(start), F.col("_e").alias(end)]
    return joined.select(columns).unionByName(placed.filter(~at_border).select(columns))


def union_lengths(df: DataFrame, keys: list[str], sets: dict[str, Column], start: str = "start", end: str = "end_", largest: dict[str, str] | None = None, width: int = UNION_BASES) -> DataFrame:
    """Bases covered at least once by each set of rows, for each key; `largest` (name: set) adds the longest merged interval of a set.

    One shuffle and one sort serve all sets: a row adds what reaches beyond the farthest end before it. Intervals are cut at the borders
    of bins of `width` bases, so a key is many tasks and its bins' lengths are summed. Of the merged intervals of a bin those
    at its borders may go on: they are told apart, and merged again over the bins, two rows a bin and set at most.
    """
    largest = largest or {}
    rows = _cut(df.select(*keys, start, end, *(c.alias(f"_in_{n}") for n, c in sets.items())), F.col(start), F.col(end), width)
    order = Window.partitionBy(*keys, "_bin").orderBy("_s", "_e")
    inside, to = (lambda n: F.col(f"_in_{n}")), (lambda n: F.col(f"_to_{n}"))
    rows = rows.withColumns({f"_to_{n}": F.max(F.when(inside(n), F.col("_e"))).over(order.rowsBetween(Window.unboundedPreceding, -1)) for n in sets})
    aggs = [F.sum(F.when(inside(n), F.greatest(F.col("_e") - F.greatest("_s", F.coalesce(to(n), F.col("_s"))), F.lit(0))).otherwise(0)).alias(n) for n in sets]
    for n in set(largest.values()):
        opens = F.when(inside(n) & (to(n).isNull() | (F.col("_s") > to(n))), F.col("_s"))
        rows = rows.withColumn(f"_from_{n}", F.last(opens, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        begun, reach = F.col(f"_from_{n}"), F.greatest(F.col("_e"), F.coalesce(to(n), F.col("_e")))
        first, last = F.max(F.when(inside(n), F.struct((-begun).alias("s"), reach.alias("e")))), F.max(F.when(inside(n), F.struct(begun.alias("s"), reach.alias("e"))))
        aggs += [F.max(F.when(inside(n), reach - begun)).alias(f"_long_{n}"), first.alias(f"_first_{n}"), last.alias(f"_last_{n}")]
    binned = rows.groupBy(*keys, "_bin").agg(*aggs)

    def border(n: str) -> Column:
        """The first and last merged interval of each bin, in order."""
        both = F.array(F.struct((-F.col(f"_first_{n}.s")).alias("s"), F.col(f"_first_{n}.e").alias("e")), F.struct(F.col(f"_last_{n}.s").alias("s"), F.col(f"_last_{n}.e").alias("e")))
        return F.array_sort(F.flatten(F.collect_list(F.when(F.col(f"_first_{n}").isNotNull(), both))))

    def longest(n: str) -> Column:
        def step(done: Column, x: Column) -> Column:
            goes_on = x["s"] <= done["e"]
            s, e = F.when(goes_on, done["s"]).otherwise(x["s"]), F.when(goes_on, F.greatest(done["e"], x["e"])).otherwise(x["e"])
            return F.struct(s.alias("s"), e.alias("e"), F.greatest(done["best"], e - s).alias("best"))

        none = F.lit(None).cast("long")
        return F.aggregate(f"_border_{n}", F.struct(none.alias("s"), none.alias("e"), F.col(f"_long_{n}").cast("long").alias("best")), step, lambda done: done["best"])

    asked = set(largest.values())
    sums = binned.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in sets), *(F.max(f"_long_{n}").alias(f"_long_{n}") for n in asked), *(border(n).alias(f"_border_{n}") for n in asked))
    return sums.select(*keys, *sets, *(longest(n).alias(name) for name, n in largest.items()))


def union_length(df: DataFrame, keys: list[str], start: str = "start", end: str = "end_", name: str = "covered_bp") -> DataFrame:
    """Bases covered at least once by each key."""
    return union_lengths(df, keys, {name: F.lit(True)}, start, end)


def bins(start: Column, end: Column, width: int) -> Column:
    """The bins of `width` bases that a half-open interval touches; an empty interval counts as its position."""
    return F.explode(F.sequence(F.floor(start / width), F.floor(F.greatest(end - 1, start) / width)))


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], a_start: str, a_end: str, b_start: str, b_end: str, width: int = 10_000) -> DataFrame:
    """JN-5: pairs with the same `keys` that share a base. Columns of `a` and `b` must differ apart from `keys`.

    A pair meets in each bin both touch; it is kept in the bin where the later of the two starts, so no distinct is needed.
    """
    left = a.withColumn("_bin", bins(F.col(a_start), F.col(a_end), width))
    right = b.withColumn("_bin", bins(F.col(b_start), F.col(b_end), width))
    pairs = left.join(right, [*keys, "_bin"])
    first = F.floor(F.greatest(F.col(a_start), F.col(b_start)) / width)
    return pairs.filter((F.col(a_start) < F.col(b_end)) & (F.col(b_start) < F.col(a_end)) & (F.col("_bin") == first)).drop("_bin")


def intersection_length(a: DataFrame, b: DataFrame, keys: list[str], start: str = "start", end: str = "end_", name: str = "shared_bp") -> DataFrame:
    """AGG-5: bases covered by both sets, for keys that have any: what both unions hold beyond the union of all."""
    rows = a.select(*keys, start, end, F.lit(True).alias("_a")).unionByName(b.select(*keys, start, end, F.lit(False).alias("_a")))
    sums = union_lengths(rows, keys, {"_one": F.col("_a"), "_other": ~F.col("_a"), "_all": F.lit(True)}, start, end)
    return sums.select(*keys, (F.col("_one") + F.col("_other") - F.col("_all")).alias(name)).filter(F.col(name) > 0)


def complement_intervals(df: DataFrame, lengths: DataFrame, keys: list[str], start: str = "start", end: str = "end_", length: str = "length") -> DataFrame:
    """AGG-6: what merged intervals leave of [0, length), for every key of `lengths`."""
    merged = merge_intervals(df, keys, start, end).join(lengths, keys).select(*keys, F.least(start, length).alias("_s"), F.least(end, length).alias("_e"))
    ends = lengths.select(*keys, F.col(length).alias("_s"), F.col(length).alias("_e"))
    own = Window.partitionBy(*keys).orderBy("_s", "_e")
    gaps = merged.unionByName(ends).select(*keys, F.coalesce(F.lag("_e").over(own), F.lit(0)).alias(start), F.col("_s").alias(end))
    return gaps.filter(F.col(start) < F.col(end))


def relation(p_start: Column, p_end: Column, f_start: Column, f_end: Column) -> Column:
    """Label of a locus against a feature: AT_BOUNDARY or INSIDE for a locus without length, else AFFECTED or FLANK."""
    point = p_start == p_end
    edge = (p_start == f_start) | (p_start == f_end)
    touches = (p_start < f_end) & (f_start < p_end)
    return F.when(point & edge, "AT_BOUNDARY").when(point & (f_start < p_start) & (p_start < f_end), "INSIDE").when(~point & touches, "AFFECTED").otherwise("FLANK")


def window_join(loci: DataFrame, features: DataFrame, keys: list[str], w: int = 100_000, nested: tuple[int, ...] = (2_000, 10_000, 100_000), width: int = 100_000) -> DataFrame:
    """JN-7: features within `w` of a locus with distance and the smallest of the `nested` windows that holds it."""
    padded = loci.withColumns({"_ps": F.greatest(F.col("locus_start") - w - 1, F.lit(0)), "_pe": F.col("locus_end") + w + 1})
    pairs = overlap_join(padded, features, keys, "_ps", "_pe", "start", "end_", width).drop("_ps", "_pe")
    pairs = pairs.withColumn("distance", distance(F.col("locus_start"), F.col("locus_end"), F.col("start"), F.col("end_"))).filter(F.col("distance") <= w)
    label = reduce(lambda c, n: F.when(F.col("distance") <= n, n).otherwise(c), sorted(nested, reverse=True), F.lit(None).cast("int"))
    return pairs.withColumn("within", label)


def distance(l_start: Column, l_end: Column, f_start: Column, f_end: Column) -> Column:
    """0 if they touch, else the bases between."""
    return F.greatest(f_start - l_end, l_start - f_end, F.lit(0))


def nearest_join(loci: DataFrame, features: DataFrame, keys: list[str], width: int = 100_000) -> DataFrame:
    """JN-6: the nearest features of each locus, all ties kept, with their distance.

    The two candidate distances (the feature that starts next, the greatest end before) come from one sorted pass over
    both tables, cut in ranges of `width` bases; what lies before and after a range is carried in a table of one row a range.
    A second join on the distance then finds every feature at that distance. Loci: locus_id, locus_start,
    locus_end; features: start, end_.
    """
    marks = features.select(*keys, F.col("start").alias("_at"), F.lit(0).alias("_kind"), "start", "end_", F.lit(None).cast("string").alias("locus_id"), F.lit(None).cast("long").alias("locus_start"), F.lit(None).cast("long").alias("locus_end"))
    asks = loci.select(*keys, F.col("locus_end").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end_"), "locus_id", "locus_start", "locus_end")
    both = marks.unionByName(asks).withColumn("_range", F.floor(F.col("_at") / width))
    edge = Window.partitionBy(*keys).orderBy("_range")
    ranges = both.groupBy(*keys, "_range").agg(F.max("end_").alias("_far"), F.min("start").alias("_near"))
    ranges = ranges.select(*keys, "_range", F.max("_far").over(edge.rowsBetween(Window.unboundedPreceding, -1)).alias("_far"), F.min("_near").over(edge.rowsBetween(1, Window.unboundedFollowing)).alias("_near"))
    up = Window.partitionBy(*keys, "_range").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    # the rows after, read backwards: a frame that ends at the last row would be summed anew for each row
    down = Window.partitionBy(*keys, "_range").orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({"_end": F.max("end_").over(up), "_next": F.min("start").over(down)}).filter("_kind = 1").join(ranges, [*keys, "_range"])
    found = found.withColumns({"_end": F.greatest("_end", "_far"), "_next": F.least("_next", "_near")})
    before = F.greatest(F.col("locus_start") - F.col("_end"), F.lit(0))
    found = found.select(*keys, "locus_id", "locus_start", "locus_end", F.least(before, F.col("_next") - F.col("locus_end")).alias("distance")).filter("distance is not null")
    # features at exactly that distance: those that touch, end there or start there
    touching = overlap_join(
        found.filter("distance = 0").withColumns({"_ls": F.col("locus_start") - 1, "_le": F.col("locus_end") + 1}), features, keys, "_ls", "_le", "start", "end_", 50_000
    ).drop("_ls", "_le")
    apart = found.filter("distance > 0")
    ending = apart.join(features, (F.col("locus_start") - F.col("distance") == F.col("end_")) & reduce(lambda x, y: x & y, [apart[k] == features[k] for k in keys])).drop(*[features[k] for k in keys])
    starting = apart.join(features, (F.col("locus_end") + F.col("distance") == F.col("start")) & reduce(lambda x, y: x & y, [apart[k] == features[k] for k in keys])).drop(*[features[k] for k in keys])
    return touching.filter(distance(F.col("locus_start"), F.col("locus_end"), F.col("start"), F.col("end_")) == 0).unionByName(ending).unionByName(starting)


def bed_context(points: DataFrame, beds: DataFrame, padding: int) -> DataFrame:
    """JN-8: (locus_id, context): labels of the BED sets within `padding` of a point, NO_OVERLAP, CONTIG_NOT_IN_BED or NOT_ASSESSED without any BED.

    Points: locus_id, chromosome, position_0; beds: chromosome, start, end_, label.
    """
    # where a label holds: merged, so that a point meets a label once, however many of its intervals are around it
    around = beds.filter("end_ > 0").select("chromosome", "label", (F.col("start") - padding).alias("_from"), (F.col("end_") + padding).alias("_to")).filter("_from < _to")
    merged = merge_intervals(around, ["chromosome", "label"], "_from", "_to")
    spans = points.select("locus_id", "chromosome", F.col("position_0").alias("_s"), (F.col("position_0") + 1).alias("_e"))
    hits = overlap_join(spans, merged, ["chromosome"], "_s", "_e", "_from", "_to").groupBy("locus_id").agg(F.array_join(F.array_sort(F.collect_set("label")), ";").alias("_hit"))
    known = beds.select("chromosome").distinct().withColumn("_known", F.lit(True))
    any_bed = beds.limit(1).select(F.lit(True).alias("_any"))
    joined = points.join(hits, "locus_id", "left").join(known, "chromosome", "left").join(F.broadcast(any_bed), F.lit(True), "left")
    context = F.when(F.col("_any").isNull(), "NOT_ASSESSED").when(F.col("_hit").isNotNull(), F.col("_hit")).when(F.col("_known"), "NO_OVERLAP").otherwise("CONTIG_NOT_IN_BED")
    return joined.select("locus_id", context.alias("context"))


def length_compatible(a: Column, b: Column, similarity: float) -> Column:
    """Length ratio at least `similarity`; a length of zero is compatible with any."""
    return (a == 0) | (b == 0) | (F.least(a, b) / F.greatest(a, b) >= similarity)


def sv_match(a: DataFrame, b: DataFrame, distance: int = 500, similarity: float = 0.7) -> DataFrame:
    """JN-9: breakpoint band join of variants: same frame, chromosome and type, positions at most `distance` apart, compatible lengths.

    `b` comes with columns other_id, other_position_0, other_svlen. `b` goes to the bins beside its own too, `a` to its own only.
    """
    left = a.withColumn("_bin", F.floor(F.col("position_0") / distance))
    right = b.withColumn("_bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.col("other_position_0") / distance) + i)))
    pairs = left.join(right, ["frame", "chromosome", "svtype", "_bin"]).drop("_bin")
    near = F.abs(F.col("position_0") - F.col("other_position_0")) <= distance
    return pairs.filter(near & length_compatible(F.col("svlen"), F.col("other_svlen"), similarity))


def locate_in_cuts(targets: DataFrame, cuts: DataFrame, keys: list[str], slack: int) -> DataFrame:
    """WIN-14: for each target the nearest cut at most `slack` away, the left one on a tie. Targets: target; cuts: cut."""
    padded = targets.withColumns({"_s": F.col("target") - slack, "_e": F.col("target") + slack + 1})
    points = cuts.select(*keys, "cut", F.col("cut").alias("_cs"), (F.col("cut") + 1).alias("_ce"))
    near = overlap_join(padded, points, keys, "_s", "_e", "_cs", "_ce", max(2 * slack, 1))
    return near.groupBy(*keys, "target").agg(F.min_by("cut", F.struct(F.abs(F.col("cut") - F.col("target")), F.col("cut"))).alias("cut"))
