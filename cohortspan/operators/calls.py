"""Imported caller records: repeat genotypes, copy-number segments, and what each file did not report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Call states of repeats and segment states of copy numbers, as imports count them.
REPEAT_STATES = ("CALLER_PASS", "LOW_DEPTH", "PARTIAL_GENOTYPE", "NO_CALL", "FILTERED_OR_UNASSESSED", "NOT_IN_CATALOG", "CATALOG_COORDINATE_MISMATCH", "RECORD_NOT_REPORTED", "VCF_UNAVAILABLE")
SEGMENT_STATES = ("REPORTED_REFERENCE_SEGMENT", "REPORTED_CNV", "MISSING_CN", "UNSUPPORTED_ALLELE_REPRESENTATION")


def _digits(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^[0-9]+\z"), F.lit(False))


def parse_repeat_calls(df: DataFrame) -> DataFrame:
    """SCL-29: repeat units and confidence interval of up to two alleles, and the state of the call.

    Rows: chromosome, pos, end_, filter, gt, repcn, repci of the record and catalog_found, catalog_chromosome,
    catalog_start, catalog_end of its locus; `pos` is the base before the repeat and so equals the 0-based start. The
    columns given stay. Records off their locus get no allele columns. A null field counts as `.`.
    """
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("gt", "repcn", "repci", "filter")}
    gt, counts, cis = F.split(known["gt"], "[/|]"), F.split(known["repcn"], "/"), F.split(known["repci"], "/")
    usable = F.col("catalog_found") & (F.col("chromosome") == F.col("catalog_chromosome")) & (F.col("pos") == F.col("catalog_start")) & (F.col("end_") == F.col("catalog_end"))
    usable = F.coalesce(usable, F.lit(False))
    interval = r"^([0-9]+)-([0-9]+)\z"
    alleles, whole = {}, F.size(gt).isin(1, 2) & (F.size(counts) == F.size(gt)) & (F.size(cis) == F.size(gt))
    called = F.lit(False)
    for i in (0, 1):
        here = F.size(gt) > i
        count, ci = F.get(counts, F.lit(i)), F.get(cis, F.lit(i))
        units = F.when(usable & here & _digits(count), count.try_cast("bigint"))
        low, high = (F.when(usable & here & ci.rlike(interval), F.regexp_extract(ci, interval, g).try_cast("bigint")) for g in (1, 2))
        alleles |= {f"allele{i + 1}_repeat_units": units, f"allele{i + 1}_ci_low": low, f"allele{i + 1}_ci_high": high}
        called = called | units.isNotNull()
        whole = whole & (~here | (_digits(F.get(gt, F.lit(i))) & F.coalesce(units.between(low, high), F.lit(False))))
    state = (
        F.when(~F.coalesce(F.col("catalog_found"), F.lit(False)), "NOT_IN_CATALOG").when(~usable, "CATALOG_COORDINATE_MISMATCH")
        .when(F.array_contains(F.split(known["filter"], ";"), "LowDepth"), "LOW_DEPTH").when(~whole & called, "PARTIAL_GENOTYPE").when(~whole, "NO_CALL")
        .when(known["filter"] != "PASS", "FILTERED_OR_UNASSESSED").otherwise("CALLER_PASS")
    )
    return df.withColumns({"allele_count": F.when(usable, F.size(gt)), **alleles, "call_status": state})


def classify_cn_segments(df: DataFrame) -> DataFrame:
    """SCL-30: type, state and 0-based start of copy-number segments; `valid` is false for an empty or negative span or a copy number that is no count.

    Rows: pos (1-based), end_, alt, gt, cn. A null field counts as `.`.
    """
    alt, gt, cn = (F.coalesce(F.col(c), F.lit(".")) for c in ("alt", "gt", "cn"))
    svtype = F.when(alt == "<DEL>", "DEL").when(alt == "<DUP>", "DUP")
    reference = (alt == ".") & gt.isin("0", "0/0", "0|0")
    state = F.when(cn == ".", "MISSING_CN").when(svtype.isNotNull(), "REPORTED_CNV").when(reference, "REPORTED_REFERENCE_SEGMENT").otherwise("UNSUPPORTED_ALLELE_REPRESENTATION")
    valid = (F.col("pos") >= 1) & (F.col("end_") > F.col("pos") - 1) & ((cn == ".") | _digits(cn))
    kind = F.when((cn != ".") & svtype.isNull() & reference, "REF").otherwise(F.coalesce(svtype, F.lit("unknown")))
    return df.withColumns({"start_0": F.col("pos") - 1, "svtype": kind, "reported_state": state, "valid": F.coalesce(valid, F.lit(False))})


def complete_repeat_calls(selected: DataFrame, files: DataFrame, calls: DataFrame) -> DataFrame:
    """JN-33: every selected locus of every file, with an explicit state where the file has no record of it.

    Selected: variant, catalog_found; files: file, file_status (READ, VCF_UNAVAILABLE, NO_SAMPLE_HEADER or
    HEADER_ONLY_OR_TRUNCATED); calls: file, variant, call_status and more. The grid is the result's definition; calls
    join it by (file, variant).
    """
    grid = files.select("file", "file_status").crossJoin(selected.select("variant", "catalog_found"))
    rows = grid.join(calls.drop("catalog_found"), ["file", "variant"], "left")
    missing = F.when(F.col("file_status") != "READ", F.col("file_status")).when(~F.col("catalog_found"), "NOT_IN_CATALOG").otherwise("RECORD_NOT_REPORTED")
    return rows.withColumn("call_status", F.coalesce("call_status", missing))


def import_status(calls: DataFrame, file: str, state: str, states: tuple[str, ...]) -> DataFrame:
    """AGG-51: records of each file and how many have each of the known states, in one pass."""
    return calls.groupBy(file).agg(F.count(F.lit(1)).alias("records"), *(F.count_if(F.col(state) == s).alias(s.lower()) for s in states))
