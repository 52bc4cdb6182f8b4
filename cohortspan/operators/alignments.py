"""Alignments: acceptance, CIGAR events, tiers, coverage and read-mapping metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cigar_bases, join_reasons, parse_cigar
from .intervals import UNION_BASES, _cut, merge_intervals, union_length, union_lengths

EVENT = "kind string, operation string, length bigint, svlen bigint, query_position bigint, target_position bigint, members int, left_anchor bigint, right_anchor bigint"


def identity(matches: Column, block: Column) -> Column:
    return F.when(block > 0, matches / block).otherwise(F.lit(0.0))


def accepted(min_mapq: int, min_identity: float, min_length: int) -> Column:
    return (F.col("mapq") >= min_mapq) & (identity(F.col("matches"), F.col("block")) >= min_identity) & (F.col("block") >= min_length)


def filter_alignments(df: DataFrame, min_mapq: int = 0, min_identity: float = 0.0, min_length: int = 0, primary: bool = False) -> DataFrame:
    """FLT-6: mapq, matches / block (0 for an empty block), block length, and primary only if asked."""
    keep = accepted(min_mapq, min_identity, min_length)
    return df.filter(keep & ~F.col("is_secondary") if primary else keep)


#: Bytes of CIGARs that are taken apart at a time.
_CIGAR_BYTES = 1 << 24


def _operations(cigars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, operation (as a byte) and length of all operations of some CIGARs, in order; what is no operation is passed over."""
    cigars = cigars.cast(pa.large_binary())
    offsets = np.frombuffer(cigars.buffers()[1], np.int64)[cigars.offset : cigars.offset + len(cigars) + 1]
    data = cigars.buffers()[2]
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    digit = text - np.uint8(48) < 10
    ends = np.flatnonzero(~digit)
    row = np.searchsorted(offsets, ends, "right") - 1
    begins = np.maximum(np.concatenate([[-1], ends[:-1]]) + 1, offsets[row]) if len(ends) else ends
    width = ends - begins
    real = (width > 0) & np.isin(text[ends], np.frombuffer(b"MIDNSHP=X", np.uint8))
    if (width[real] > 18).any():
        raise ValueError("a CIGAR length has more than 18 digits")
    ends, begins, row, width = ends[real], begins[real], row[real], width[real]
    length = np.zeros(len(ends), np.int64)
    for k in range(int(width.max()) if len(width) else 0):  # as many steps as the longest number has digits
        own = k < width
        length[own] = length[own] * 10 + (text[begins[own] + k] - np.uint8(48))
    return row, text[ends], length


def _event_rows(cigars: pa.Array, query: np.ndarray, target: np.ndarray, raw_min: int, gap: int, cluster_min: int) -> tuple[np.ndarray, list[pa.Array]]:
    """The row and the columns of EVENT of every event, found for all rows at once by sums along one flat array of operations."""
    row, op, n = _operations(cigars)
    is_ = lambda letters: np.isin(op, np.frombuffer(letters, np.uint8))
    aligned_n = np.where(is_(b"M=X"), n, 0)

    def before(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What lies before each operation in its row, and the sum of each row."""
        sums = np.concatenate([[0], np.cumsum(steps)])
        first = np.searchsorted(row, np.arange(len(cigars) + 1))
        return sums[:-1] - sums[first[row]], sums[first[1:]] - sums[first[:-1]]

    in_query, in_target = before(np.where(is_(b"IS"), n, aligned_n))[0], before(np.where(is_(b"DN"), n, aligned_n))[0]
    aligned, whole = before(aligned_n)
    at = np.flatnonzero(is_(b"ID"))
    row, n, left, ins = row[at], n[at], aligned[at], op[at] == ord("I")
    q, t, right = query[row] + in_query[at], target[row] + in_target[at], whole[row] - left

    atom = n >= raw_min
    away = np.maximum(q[1:] - q[:-1] - np.where(ins, n, 0)[:-1], t[1:] - t[:-1] - np.where(ins, 0, n)[:-1])
    starts = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (away > gap)])) if len(at) else at
    lasts = np.concatenate([starts[1:], [len(at)]]) - 1 if len(at) else at
    inserted = np.add.reduceat(np.where(ins, n, 0), starts) if len(at) else n
    deleted = np.add.reduceat(np.where(ins, 0, n), starts) if len(at) else n
    run = (lasts > starts) & (inserted + deleted >= cluster_min)
    first, last, inserted, deleted = starts[run], lasts[run], inserted[run], deleted[run]

    names = np.array(["I", "D", "ID"], object)
    both = lambda a, b: pa.array(np.concatenate([a, b]).astype(np.int64))
    kind = pa.array(["atomic"] * int(atom.sum()) + ["cluster"] * len(first), pa.string())
    operation = pa.array(names[np.concatenate([np.where(ins[atom], 0, 1), np.where(deleted == 0, 0, np.where(inserted == 0, 1, 2))])], pa.string())
    columns = [
        kind, operation, both(n[atom], inserted + deleted), both(np.where(ins, n, -n)[atom], inserted - deleted), both(q[atom], q[first]), both(t[atom], t[first]),
        pa.array(np.concatenate([np.ones(int(atom.sum()), np.int32), (last - first + 1).astype(np.int32)])), both(left[atom], left[first]), both(right[atom], right[last]),
    ]
    return np.concatenate([row[atom], row[first]]), columns


def cigar_events(df: DataFrame, raw_min_size: int = 30, cluster_gap: int = 50, cluster_min: int = 50, keep: list[str] | None = None) -> DataFrame:
    """SCL-7: one row for each indel of at least `raw_min_size` and each run of indels at most `cluster_gap` apart with `cluster_min` bases in sum.

    Runs come in addition to their atoms; atoms below `raw_min_size` count in runs. The input has cigar, qstart and tstart; the columns
    `keep` (all without it) go along. A CIGAR of any length stays in its row, so nothing is shuffled; rows go through Arrow, and
    the operations of some MB of CIGARs are one flat array. A row that lacks its CIGAR or a start has no events.
    """
    keep = df.columns if keep is None else keep
    rows = df.filter("cigar is not null and qstart is not null and tstart is not null")
    rows = rows.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col("cigar").alias("_cigar"), F.col("qstart").cast("long").alias("_q"), F.col("tstart").cast("long").alias("_t"))
    kept = len(keep)
    names = [f"_{i}" for i in range(kept)] + [c.split()[0] for c in EVENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(kept)), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < batch.num_rows:
                hi = max(int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + _CIGAR_BYTES, "right")), lo + 1)
                part = batch.slice(lo, hi - lo)
                row, columns = _event_rows(part.column(kept), part.column(kept + 1).to_numpy(), part.column(kept + 2).to_numpy(), raw_min_size, cluster_gap, cluster_min)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(pa.array(row)) for i in range(kept)), *columns], names=names)
                lo = hi

    types = "".join(f"_{i} {df.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    found = rows.mapInArrow(run, types + EVENT)
    return found.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *names[kept:])


def tier_events(df: DataFrame, min_sv_size: int = 50, min_alignment: int = 5000, min_identity: float = 0.9, min_mapq: int = 20, min_anchor: int = 1000) -> DataFrame:
    """FLT-7: tier and ordered reasons of each event."""
    reasons = join_reasons(
        (F.col("length") < min_sv_size, "BELOW_50_BP_PENDING_NORMALIZATION"),
        (~F.col("is_primary"), "SECONDARY_ALIGNMENT"),
        (F.col("block") < min_alignment, "SHORT_ALIGNMENT"),
        (F.col("identity") < min_identity, "LOW_IDENTITY"),
        (F.col("mapq") < min_mapq, "LOW_MAPQ"),
        (F.col("left_anchor") < min_anchor, "WEAK_LEFT_ANCHOR"),
        (F.col("right_anchor") < min_anchor, "WEAK_RIGHT_ANCHOR"),
        ((F.col("left_anchor") == 0) | (F.col("right_anchor") == 0), "TERMINAL_EVENT_WITHOUT_SECOND_BREAKPOINT"),
    )
    tier = F.when(F.col("length") < min_sv_size, "SENSITIVITY_SUBTHRESHOLD").when(F.col("reasons") != "", "REVIEW").otherwise("HIGH_CONFIDENCE")
    svtype = F.when(F.col("operation") == "I", "INS").when(F.col("operation") == "D", "DEL").otherwise("COMPLEX_INDEL")
    return df.withColumn("reasons", reasons).withColumns({"tier": tier, "svtype": svtype})


def validate_paf(df: DataFrame) -> DataFrame:
    """SRC-4: rows that break the strict rules, with what is wrong. Columns: qlen, qstart, qend, tlen, tstart, tend, matches, block, mapq, cigar."""
    ops = parse_cigar(F.col("cigar"))
    wrong = join_reasons(
        (~((F.col("qstart") >= 0) & (F.col("qstart") < F.col("qend")) & (F.col("qend") <= F.col("qlen"))), "query coordinates"),
        (~((F.col("tstart") >= 0) & (F.col("tstart") < F.col("tend")) & (F.col("tend") <= F.col("tlen"))), "target coordinates"),
        (F.col("matches") > F.col("block"), "matches above block"),
        (~F.col("mapq").between(0, 255), "mapq"),
        (ops.isNull(), "cigar"),
        (F.col("cigar").rlike("[SHP]"), "clipped cigar"),
        (cigar_bases(ops, "MI=X") != F.col("qend") - F.col("qstart"), "query span"),
        (cigar_bases(ops, "MDN=X") != F.col("tend") - F.col("tstart"), "target span"),
    )
    return df.withColumn("problem", wrong).filter("problem <> ''")


def alignment_summary(paf: DataFrame, totals: DataFrame, min_mapq: int = 5) -> DataFrame:
    """AGG-3: per assembly and reference: rows, covered bases, percent of the full length, identity as total matches over total blocks. Secondary rows count."""
    kept = paf.filter(F.col("mapq") >= min_mapq)
    sums = kept.groupBy("assembly_id", "reference").agg(F.count(F.lit(1)).alias("alignments"), F.sum("matches").alias("m"), F.sum("block").alias("b"))
    covered = union_length(kept, ["assembly_id", "reference", "contig"], "qstart", "qend").groupBy("assembly_id", "reference").agg(F.sum("covered_bp").alias("covered_bp"))
    joined = sums.join(covered, ["assembly_id", "reference"]).join(totals, "assembly_id")
    return joined.select("assembly_id", "reference", "alignments", "covered_bp", (100.0 * F.col("covered_bp") / F.col("total_bp")).alias("query_percent"), (100.0 * F.col("m") / F.col("b")).alias("identity_percent"))


def callable_metrics(aln: DataFrame, totals: DataFrame, min_length: int = 5000, min_identity: float = 0.9, min_mapq: int = 20) -> DataFrame:
    """AGG-13: share of each assembly in the union of primary alignments, and of those that pass the limits."""
    primary = aln.filter(~F.col("is_secondary"))
    keys = ["assembly_id", "contig"]
    good = F.coalesce(accepted(min_mapq, min_identity, min_length), F.lit(False))
    covered = union_lengths(primary, keys, {"primary_bp": F.lit(True), "callable_bp": good}, "qstart", "qend")
    sums = covered.groupBy("assembly_id").agg(F.sum("primary_bp").alias("primary_bp"), F.sum("callable_bp").alias("callable_bp"))
    joined = totals.join(sums, "assembly_id", "left").fillna(0, ["primary_bp", "callable_bp"])
    total = F.greatest("total_bp", F.lit(1))
    return joined.select("assembly_id", "primary_bp", "callable_bp", (F.col("primary_bp") / total).alias("primary_fraction"), (F.col("callable_bp") / total).alias("callable_fraction"))


def _share(n: Column, total: Column) -> Column:
    return F.when(total != 0, n / total)


def histogram_median(value: str = "mapq", frequency: Column | None = None) -> Column:
    """AGG-14: exact median; the mean of the two middle values of an even count."""
    return F.percentile(value, 0.5) if frequency is None else F.percentile(value, 0.5, frequency)


def mapping_metrics_input(aln: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-9: shares of all input reads; MAPQ 255 is left out of MAPQ figures; unmapped and empty rows are not mapped."""
    mapped = ~F.col("is_secondary") & (F.col("path") != "*") & (F.col("block") > 0)
    q = F.when(mapped & F.col("mapq").between(0, 254), F.col("mapq"))
    agg = aln.groupBy(*keys).agg(
        F.count_if(mapped).alias("primary"),
        F.count_if(F.col("is_secondary")).alias("secondary"),
        *(F.count_if(c).alias(n) for n, c in (("q0", q == 0), ("q5", q >= 5), ("q20", q >= 20), ("q40", q >= 40))),
        F.avg(q).alias("mean_mapq"),
        F.percentile(q, 0.5).alias("median_mapq"),
        F.sum(F.when(mapped, F.col("matches") / F.col("block"))).alias("i"),
        F.sum(F.when(mapped, F.greatest(F.col("qend") - F.col("qstart"), F.lit(0)))).alias("a"),
        F.sum(F.when(mapped, F.greatest("qstart", F.lit(0)) + F.greatest(F.col("qlen") - F.col("qend"), F.lit(0)))).alias("c"),
    )
    j = agg.join(totals, keys)
    n = F.col("input_reads")
    return j.select(
        *keys, F.col("primary").alias("primary_mapped_reads"), _share(F.col("primary"), n).alias("mapped_read_fraction"), _share(F.col("q0"), n).alias("mapq_0_fraction"), _share(F.col("q5"), n).alias("mapq_ge_5_fraction"),
        _share(F.col("q20"), n).alias("mapq_ge_20_fraction"), _share(F.col("q40"), n).alias("mapq_ge_40_fraction"), "mean_mapq", "median_mapq", _share(F.col("i"), F.col("primary")).alias("mean_alignment_identity"),
        _share(F.col("a"), F.col("input_bases")).alias("fraction_read_bases_aligned"), _share(F.col("c"), F.col("primary")).alias("clipped_bases_per_read"), _share(F.col("secondary"), n).alias("secondary_multimapping_fraction"),
    )


def mapping_metrics_primary(aln: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-10: shares of primary rows, MAPQ 255 included; unmapped reads are the input reads without a primary row, never below 0."""
    mapped = ~F.col("is_secondary") & (F.col("path") != "*")
    agg = aln.groupBy(*keys).agg(
        F.count_if(mapped).alias("primary"),
        F.count_if(F.col("is_secondary")).alias("secondary"),
        *(F.count_if(mapped & c).alias(n) for n, c in (("q0", F.col("mapq") == 0), ("q20", F.col("mapq") >= 20))),
        F.percentile(F.when(mapped, F.col("mapq")), 0.5).alias("median_mapq"),
        F.avg(F.when(mapped & (F.col("qlen") > 0), (F.col("qend") - F.col("qstart")) / F.col("qlen"))).alias("mean_query_fraction"),
    )
    j = agg.join(totals, keys)
    return j.select(
        *keys, F.col("primary").alias("primary_alignments"), F.greatest(F.col("input_reads") - F.col("primary"), F.lit(0)).alias("unmapped_reads"), "secondary", _share(F.col("q0"), F.col("primary")).alias("mapq0_fraction"),
        _share(F.col("q20"), F.col("primary")).alias("mapq20_fraction"), "median_mapq", "mean_query_fraction",
    )


#: Alignments of a task that puts those of each read in order.
READ_ROWS = 1_000_000


def mapping_metrics_long(aln: DataFrame, keys: list[str], read: str = "read_name") -> DataFrame:
    """AGG-11: mapped reads, union of query bases, split reads (several non-secondary rows), multimapped reads, and exact p10/p50/p90 of length and MAPQ over all rows."""
    # one shuffle by read and bin, in tasks of about so many rows however large the table is: intervals cut at borders of bins are put in order, rows counted in their first bin
    parts = max(aln.count() // READ_ROWS + 1, int(aln.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = [*keys, read, "_bin"]
    cut = _cut(aln.select(*keys, read, "is_secondary", "qstart", "qend"), F.col("qstart"), F.col("qend"), UNION_BASES)
    own = F.col("_bin").isNull() | (F.col("_bin") == F.floor(F.col("qstart") / UNION_BASES))
    rows = cut.select(*cells, "_s", "_e", (~F.col("is_secondary")).alias("_p"), own.alias("_own")).repartition(parts, *cells)
    primary = lambda c: F.when(F.col("_p"), c)
    before = F.max(primary(F.col("_e"))).over(Window.partitionBy(*cells).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1))
    new = primary(F.greatest(F.col("_e") - F.greatest("_s", F.coalesce(before, F.col("_s"))), F.lit(0)))
    binned = rows.withColumn("_new", new).groupBy(*cells).agg(F.sum("_new").alias("_bp"), F.count_if(F.col("_own") & F.col("_p")).alias("p"), F.count_if(F.col("_own") & ~F.col("_p")).alias("s"))
    per_read = binned.groupBy(*keys, read).agg(F.sum("_bp").alias("_bp"), F.sum("p").alias("p"), F.sum("s").alias("s"))
    reads = per_read.groupBy(*keys).agg(F.count_if(F.col("p") > 0).alias("mapped_reads"), F.count_if(F.col("p") > 1).alias("split_reads"), F.count_if(F.col("s") > 0).alias("multimapped_reads"), F.sum("_bp").alias("aligned_bp"))
    quantiles = aln.groupBy(*keys).agg(*(F.percentile(c, p / 100).alias(f"{n}_p{p}") for n, c in (("length", F.col("qend") - F.col("qstart")), ("mapq", F.col("mapq"))) for p in (10, 50, 90)))
    return reads.join(quantiles, keys)


def mapping_metrics_linear(records: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-12: SAM fields (flag, mapq, cigar, nm): primary mapped rows only, identity = (block - NM) / block."""
    ops = parse_cigar(F.col("cigar"))
    rows = records.filter((F.col("flag").bitwiseAND(F.lit(0x904)) == 0) & ops.isNotNull()).withColumn("_block", cigar_bases(ops, "MID=X"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("primary_mapped"), F.avg("mapq").alias("mean_mapq"), F.avg(F.when(F.col("_block") > 0, (F.col("_block") - F.col("nm")) / F.col("_block"))).alias("mean_identity"), F.sum(cigar_bases(ops, "SH")).alias("clipped_bases"))


def split_alignments(aln: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-28: contigs with several primary rows, their class, and ordered lists. Rows: qstart, qend, strand, path_head, mapq."""
    ordered = F.array_sort(F.collect_list(F.struct("qstart", "qend", "strand", "path_head", "mapq")))
    rows = aln.filter(~F.col("is_secondary")).groupBy(*keys).agg(ordered.alias("o")).filter(F.size("o") > 1)
    turned, joined = F.size(F.array_distinct("o.strand")) > 1, F.size(F.array_distinct("o.path_head")) > 1
    label = F.when(turned & joined, "POTENTIAL_INVERSION_OR_TRANSLOCATION").when(joined, "POTENTIAL_DISTANT_JOIN_OR_TRANSLOCATION").when(turned, "POTENTIAL_INVERSION_OR_COMPLEX").otherwise("SPLIT_ALIGNMENT")
    text = lambda f: F.array_join(F.transform("o", f), ";")
    return rows.select(*keys, label.alias("classification"), F.size("o").cast("long").alias("alignment_count"), text(lambda r: F.concat_ws("-", r["qstart"].cast("string"), r["qend"].cast("string"))).alias("breakpoints"), text(lambda r: r["strand"]).alias("strands"))


def screen_status(unassessable: Column, split: Column, candidates: Column, residual: Column) -> Column:
    """FLT-15."""
    return F.when(unassessable, "UNASSESSABLE").when(split > 0, "SPLIT_OR_COMPLEX").when(candidates > 0, "CANDIDATE").when(residual > 0, "RESIDUAL").otherwise("SCREENED")


def screen_summary(events: DataFrame, tasks: DataFrame) -> DataFrame:
    """AGG-29: events by tier for every assembly of `tasks`, zeros included, with the status."""
    agg = events.groupBy("assembly_id").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("tier") == "HIGH_CONFIDENCE").alias("high_confidence"), F.count_if(F.col("tier") == "REVIEW").alias("review"))
    joined = tasks.join(agg, "assembly_id", "left").fillna(0, ["events", "high_confidence", "review"])
    return joined.withColumn("status", screen_status(F.lit(False), F.lit(0), F.col("high_confidence"), F.col("events")))


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """WIN-8: the first row of each key in `order`."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_nth = 1").drop("_nth")


def visits(df: DataFrame, keys: list[str], max_gap: int) -> DataFrame:
    """WIN-5: consecutive rows of one chunk by query start, at most `max_gap` apart, as one interval each. Rows: chunk, qstart, qend."""
    own = Window.partitionBy(*keys).orderBy("qstart", "qend", "chunk")
    new = F.when((F.col("chunk") == F.lag("chunk").over(own)) & (F.col("qstart") <= F.lag("qend").over(own) + max_gap), 0).otherwise(1)
    marked = df.withColumn("_new", new).withColumn("_visit", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_visit", "chunk").agg(F.min("qstart").alias("start"), F.max("qend").alias("end_"), F.count(F.lit(1)).alias("alignments")).drop("_visit")


def coverage_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """Merged alignment blocks on the query."""
    return merge_intervals(df, keys, "qstart", "qend")
