"""Column expressions: identifiers, tags, CIGARs, graph paths, sequences, labels. No UDF in here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing value, by source of the table.
MISSING = {"manifest": ("", "NA", "nan"), "measurement": ("", ".", "NA", "unknown"), "inventory": ("", "unknown", "n/a", "not_assessed", "none", ".")}
ASSEMBLY_ID = r"^(.+?)[._-](hap[12])(?:[._-].*)?$"
FASTA_SUFFIXES = (".fasta.gz", ".fa.gz", ".fna.gz", ".fasta", ".fna", ".fa")


def known(col: Column, vocabulary: str = "manifest") -> Column:
    """The trimmed value, or null where it is one of the vocabulary's words for missing."""
    value = F.trim(col)
    return F.when(~F.lower(value).isin([w.lower() for w in MISSING[vocabulary]]), value)


def first_known(*cols: Column, vocabulary: str = "manifest") -> Column:
    """SCL-27: the first value that is not missing."""
    return F.coalesce(*(known(c, vocabulary) for c in cols))


def flag(col: Column) -> Column:
    """SCL-27: yes, no or unknown as true, false or null; any other word is an error."""
    value = F.lower(F.trim(col))
    wrong = F.raise_error(F.concat(F.lit("not a yes/no/unknown flag: "), F.coalesce(value, F.lit("null"))))
    return F.when(value == "yes", True).when(value == "no", False).when(value.isin("unknown", "") | value.isNull(), F.lit(None).cast("boolean")).otherwise(wrong.cast("boolean"))


def to_long(col: Column) -> Column:
    """SCL-27: an integer, directly or through a whole double; null otherwise."""
    wide = col.try_cast("double")
    return F.coalesce(col.try_cast("bigint"), F.when(wide == F.floor(wide), wide.cast("bigint")))


def sampling_age(col: Column) -> Column:
    """SCL-27: finite ages from 0 on."""
    value = col.try_cast("double")
    return F.when((value >= 0) & (value < float("inf")), value)


def parse_assembly_id(col: Column) -> Column:
    """SCL-1: struct(sample, haplotype); an id that does not match is its own sample of haplotype `unknown`."""
    matched = col.rlike(ASSEMBLY_ID)
    return F.struct(
        F.when(matched, F.regexp_extract(col, ASSEMBLY_ID, 1)).otherwise(col).alias("sample"), F.when(matched, F.regexp_extract(col, ASSEMBLY_ID, 2)).otherwise(F.lit("unknown")).alias("haplotype")
    )


def normalize_assembly_id(col: Column) -> Column:
    """SCL-2: base name without FASTA suffix (the longest that fits) and without `.clean`."""
    base = F.regexp_replace(col, r"^.*/", "")
    suffixes = "|".join(s.replace(".", r"\.") for s in FASTA_SUFFIXES)
    return F.regexp_replace(F.regexp_replace(base, f"(?:{suffixes})$", ""), r"\.clean$", "")


def normalize_chrom(col: Column, style: str) -> Column:
    """SCL-3: `bare` (no prefix, no chr, upper X/Y/MT, M is MT), `unprefixed` (no prefix only) or `chr` (no prefix, chr on canonical names)."""
    last = F.regexp_replace(col, r"^.*[#.]", "")
    if style == "unprefixed":
        return last
    bare = F.regexp_replace(last, r"(?i)^chr", "")
    upper = F.when(F.upper(bare).isin("X", "Y", "MT"), F.upper(bare)).when(F.upper(bare) == "M", F.lit("MT")).otherwise(bare)
    if style == "bare":
        return upper
    if style == "chr":
        return F.when(upper.rlike(r"^(?:[1-9]|1[0-9]|2[0-2]|X|Y)$"), F.concat(F.lit("chr"), upper)).when(upper == "MT", F.lit("chrM")).otherwise(last)
    raise ValueError(f"unknown style {style!r}")


def canonical_reference_path(col: Column, sample: str) -> Column:
    """SCL-4: without `SAMPLE#0#` or `SAMPLE.`, for the configured sample only."""
    for prefix in (f"{sample}#0#", f"{sample}."):
        col = F.when(col.startswith(prefix), F.substring(col, len(prefix) + 1, 1 << 30)).otherwise(col)
    return col


def tags_to_map(tags: Column) -> Column:
    """SCL-5: TAG:TYPE:VALUE strings as a map; a value may hold `:`, the last of several equal tags counts."""
    parts = F.filter(F.transform(tags, lambda t: F.split(t, ":", 3)), lambda p: (F.size(p) == 3) & (p[0] != "") & (p[1] != ""))
    last = lambda all_: F.filter(all_, lambda p, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda later: later[0] == p[0]))
    # a lambda's variable holds the split tags, so that they are split once a row and not once for each tag
    kept = F.transform(F.array(parts), lambda all_: F.transform(last(all_), lambda p: F.struct(p[0].alias("k"), p[2].alias("v"))))[0]
    return F.map_from_entries(kept)


def info_to_map(col: Column) -> Column:
    """SCL-8: VCF INFO as a map; flags have a null value."""
    return F.str_to_map(col, F.lit(";"), F.lit("="))


def format_to_map(fmt: Column, call: Column) -> Column:
    """SCL-9: FORMAT keys with the sample's values; values missing at the end are null."""
    keys, values = F.split(fmt, ":"), F.split(call, ":")
    return F.map_from_arrays(keys, F.transform(keys, lambda k, i: F.get(values, i)))


def cigar_well_formed(col: Column) -> Column:
    return col.rlike(r"^(?:[0-9]+[MIDNSHP=X])+\z")


def parse_cigar(col: Column) -> Column:
    """SCL-6: array of struct(len, op); null for a malformed CIGAR."""
    lengths = F.transform(F.regexp_extract_all(col, F.lit("([0-9]+)[MIDNSHP=X]"), F.lit(1)), lambda n: n.cast("bigint"))
    ops = F.regexp_extract_all(col, F.lit("[0-9]+([MIDNSHP=X])"), F.lit(1))
    return F.when(cigar_well_formed(col), F.arrays_zip(lengths.alias("len"), ops.alias("op")))


def cigar_bases(cigar: Column, ops: str) -> Column:
    """Bases in operations `ops` of a parsed CIGAR."""
    return F.aggregate(cigar, F.lit(0).cast("bigint"), lambda t, x: t + F.when(F.lit(ops).contains(x["op"]), x["len"]).otherwise(0))


def aligned_bases_in(cigar: Column, qstart: Column, strand: Column, qend: Column, lo: Column, hi: Column) -> Column:
    """SCL-21: query bases aligned inside [lo, hi). On the minus strand the CIGAR runs from the query's end down."""
    forward = strand == "+"
    zero = F.struct(F.when(forward, qstart).otherwise(qend).alias("at"), F.lit(0).cast("bigint").alias("n"))

    def step(s: Column, x: Column) -> Column:
        moves = F.when(F.lit("MIS=X").contains(x["op"]), x["len"]).otherwise(0)
        start = F.when(forward, s["at"]).otherwise(s["at"] - moves)
        inside = F.greatest(F.least(start + moves, hi) - F.greatest(start, lo), F.lit(0))
        return F.struct(F.when(forward, s["at"] + moves).otherwise(start).alias("at"), (s["n"] + F.when(F.lit("M=X").contains(x["op"]), inside).otherwise(0)).alias("n"))

    return F.aggregate(cigar, zero, step, lambda s: s["n"])


def event_discordance(cigar: Column, tstart: Column, ev_start: Column, ev_end: Column, window: int) -> Column:
    """SCL-22: indel bases within `window` of an event on the target: insertions at their point, deletions by span. Without a CIGAR the largest long."""
    lo, hi = ev_start - window, ev_end + window
    zero = F.struct(tstart.cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("n"))

    def step(s: Column, x: Column) -> Column:
        moves = F.when(F.lit("MDN=X").contains(x["op"]), x["len"]).otherwise(0)
        point = (x["op"] == "I") & (s["at"] >= lo) & (s["at"] <= hi)
        span = F.lit("DN").contains(x["op"]) & (s["at"] < hi) & (s["at"] + x["len"] > lo)
        return F.struct((s["at"] + moves).alias("at"), (s["n"] + F.when(point | span, x["len"]).otherwise(0)).alias("n"))

    return F.coalesce(F.aggregate(cigar, zero, step, lambda s: s["n"]), F.lit((1 << 63) - 1))


def infer_svtype(ref: Column, alt: Column, svtype: Column) -> Column:
    """SCL-10: INFO type; brackets are BND; a symbolic allele names itself; else by length."""
    symbolic = F.regexp_extract(alt, r"^<([^>:]+)", 1)
    by_length = F.when(F.length(alt) > F.length(ref), "INS").when(F.length(alt) < F.length(ref), "DEL").otherwise("SUB")
    return F.when(svtype.isNotNull() & (svtype != ""), F.upper(svtype)).when(alt.rlike(r"[\[\]]"), "BND").when(symbolic != "", F.upper(symbolic)).otherwise(by_length)


def infer_svlen(pos0: Column, ref: Column, alt: Column, svlen: Column, end: Column) -> Column:
    """SCL-11: |SVLEN| (first of a list), else |END - pos0 - 1|, else |len(alt) - len(ref)| of literal alleles, else 0."""
    first = F.split(svlen, ",")[0].try_cast("bigint")
    literal = literal_sequence(ref) & literal_sequence(alt)
    return F.coalesce(F.abs(first), F.abs(end.try_cast("bigint") - pos0 - 1), F.when(literal, F.abs(F.length(alt) - F.length(ref)).cast("bigint")), F.lit(0).cast("bigint"))


def literal_sequence(col: Column) -> Column:
    """SCL-12."""
    return col.rlike(r"^[ACGTNacgtn]+\z")


def alternate_sequence(ref: Column, alt: Column, svtype: Column) -> Column:
    """SCL-12: the inserted bases of a literal insertion, without the shared prefix `ref`."""
    return F.when((svtype == "INS") & literal_sequence(ref) & literal_sequence(alt) & F.upper(alt).startswith(F.upper(ref)), F.upper(F.substring(alt, F.length(ref) + 1, F.length(alt)))).otherwise(F.lit(""))


def stable_id(prefix: str, algorithm: str, n: int, separator: str, *cols: Column) -> Column:
    """SCL-13: prefix and the first `n` hex digits of SHA-1 or SHA-256 over the fields joined by `separator`."""
    joined = F.concat_ws(separator, *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))
    digest = F.sha1(joined) if algorithm == "sha1" else F.sha2(joined, 256)
    return F.concat(F.lit(prefix), F.substring(digest, 1, n))


def reverse_complement(col: Column, iupac: bool = False) -> Column:
    """SCL-14."""
    return F.reverse(F.translate(col, "ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb") if iupac else F.translate(col, "ACGTacgt", "TGCAtgca"))


def mask_bases(col: Column) -> Column:
    """SCL-16: struct(seq upper-cased with ambiguity codes as N, masked, lower, ok); ok is false if another symbol occurs."""
    upper = F.upper(col)
    plain = F.translate(upper, "RYSWKMBDHV", "NNNNNNNNNN")
    masked = F.length(upper) - F.length(F.translate(upper, "RYSWKMBDHV", ""))
    lower = F.length(col) - F.length(F.regexp_replace(col, "[a-z]", ""))
    return F.struct(plain.alias("seq"), masked.cast("bigint").alias("masked"), lower.cast("bigint").alias("lower"), plain.rlike(r"^[ACGTN]*\z").alias("ok"))


def fragment_name(col: Column) -> Column:
    """SCL-17: the read's first word without a mate number."""
    return F.regexp_replace(F.split(col, r"\s")[0], "/[12]$", "")


def path_tokens(col: Column) -> Column:
    """SCL-18: oriented tokens of a graph path."""
    return F.regexp_extract_all(col, F.lit("[><][^><]+"), F.lit(0))


def path_edges(tokens: Column) -> Column:
    """SCL-18: consecutive pairs as `token token`."""
    return F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda t, i: F.concat(t, F.get(tokens, i + 1)))


def flip_token(col: Column) -> Column:
    return F.concat(F.translate(F.substring(col, 1, 1), "><", "<>"), F.substring(col, 2, 1 << 30))


def flip_edge(edge: Column) -> Column:
    """SCL-18: the same edge read from the other side."""
    tokens = path_tokens(edge)
    return F.concat(flip_token(tokens[1]), flip_token(tokens[0]))


def canonical_edge(edge: Column) -> Column:
    """SCL-18: the smaller of an edge and its reverse."""
    return F.least(edge, flip_edge(edge))


def canonical_traversal(path: Column, strand: Column) -> Column:
    """SCL-19: a minus-strand traversal in forward form; tokens with coordinates give null."""
    tokens = path_tokens(path)
    turned = F.array_join(F.transform(F.reverse(tokens), flip_token), "")
    return F.when(~path.rlike(r"[><][^><]*:[0-9]+-[0-9]+"), F.when(strand == "-", turned).otherwise(path))


def traversal_difference(ref: Column, alt: Column) -> Column:
    """SCL-20: struct(prefix, suffix, junctions, reference_edges, inserted) of two token arrays."""
    shared = F.arrays_zip(ref.alias("r"), alt.alias("a"))
    n = F.least(F.size(ref), F.size(alt))
    run = lambda pairs: F.aggregate(pairs, F.struct(F.lit(True).alias("on"), F.lit(0).alias("n")), lambda s, x: F.struct((s["on"] & x["r"].eqNullSafe(x["a"])).alias("on"), (s["n"] + F.when(s["on"] & x["r"].eqNullSafe(x["a"]), 1).otherwise(0)).alias("n")), lambda s: s["n"])
    prefix = F.least(run(shared), n)
    suffix = F.least(run(F.arrays_zip(F.reverse(ref).alias("r"), F.reverse(alt).alias("a"))), n - prefix)
    inserted = F.slice(alt, prefix + 1, F.greatest(F.size(alt) - prefix - suffix, F.lit(0)))
    return F.struct(prefix.alias("prefix"), suffix.alias("suffix"), F.array_except(path_edges(alt), path_edges(ref)).alias("junctions"), F.array_except(path_edges(ref), path_edges(alt)).alias("reference_edges"), inserted.alias("inserted"))


def size_bin(length: Column, style: str) -> Column:
    """SCL-23."""
    if style == "fine":
        return F.when(length < 50, "complex under 50").when(length < 100, "50-99").when(length < 1000, "100-999").when(length < 10000, "1-9kb").otherwise(">=10kb")
    return F.when(length < 1000, "<1kb").when(length < 10000, "1-10kb").otherwise(">=10kb")


def bubble_difference(shortest: Column, longest: Column, reference: Column) -> Column:
    """SCL-24: the largest difference of an allele length from the reference."""
    return F.greatest(F.abs(shortest - reference), F.abs(longest - reference))


def bubble_class(shortest: Column, longest: Column, reference: Column, bidirectional: Column) -> Column:
    """SCL-24: INS, DEL, INV_OR_COMPLEX (bidirectional) or MULTIALLELIC_OR_COMPLEX; null if no allele length differs by 50 bases and the bubble is not bidirectional."""
    small = bubble_difference(shortest, longest, reference) < 50
    grows = (longest >= reference + 50) & (shortest >= reference - 49)
    shrinks = (shortest <= reference - 50) & (longest <= reference + 49)
    return F.when(bidirectional, "INV_OR_COMPLEX").when(small, None).when(grows, "INS").when(shrinks, "DEL").otherwise("MULTIALLELIC_OR_COMPLEX")


def sex_chromosome_status(frame: Column, chrom: Column) -> Column:
    """SCL-26."""
    return F.when(frame == "GRAPH", "NOT_ASSESSED").when(chrom.rlike("(?i)^(chr)?[XY]$"), "SEX_CHROMOSOME").otherwise("AUTOSOME")


def translate_paths(col: Column, rules: list[tuple[str, str]]) -> Column:
    """SCL-28: every path of a comma list with the first matching prefix rule applied."""

    def one(path: Column) -> Column:
        out = path
        for old, new in reversed(rules):
            out = F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(col, ","), one), ",")


def parse_truth_name(col: Column) -> Column:
    """SCL-33: struct(sample, haplotype, contig, start, end) of a simulated read's name `sim|sample|hap|contig:start-end|...`; null for other names."""
    pattern = r"^sim\|([^|]+)\|([^|]+)\|([^:|]+):([0-9]+)-([0-9]+)\|"
    part = lambda i: F.regexp_extract(col, pattern, i)
    found = F.struct(part(1).alias("sample"), part(2).alias("haplotype"), part(3).alias("contig"), part(4).try_cast("bigint").alias("start"), part(5).try_cast("bigint").alias("end"))
    return F.when(col.rlike(pattern), found)


def has_all(col: Column, required: list[str]) -> Column:
    """FLT-10: the `;` list holds all required words."""
    return F.size(F.array_except(F.array(*map(F.lit, required)), F.split(F.coalesce(col, F.lit("")), ";"))) == 0


def join_reasons(*pairs: tuple[Column, Column | str], separator: str = ";") -> Column:
    """Labels of the conditions that hold, in order."""
    found = F.array(*(F.when(c, F.lit(label) if isinstance(label, str) else label) for c, label in pairs))
    return F.array_join(F.filter(found, lambda x: x.isNotNull()), separator)
