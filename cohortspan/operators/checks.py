"""Guards: each returns the rows that break a rule; `raise_if_any` turns them into an error with a count and a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def raise_if_any(violations: DataFrame, message: str) -> None:
    found = violations.limit(6).collect()
    if found:
        raise ValueError(f"{message}: {[r.asDict() for r in found[:5]]}{' and more' if len(found) > 5 else ''}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """JN-2: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """JN-2, tolerant form: the last row of each key wins."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """JN-3: rows of `child` whose key `parent` lacks."""
    return child.join(parent.select(*keys).distinct(), keys, "left_anti")


def restrict(df: DataFrame, keys_df: DataFrame) -> DataFrame:
    """JN-4: rows whose key is listed."""
    return df.join(keys_df.distinct(), keys_df.columns, "left_semi")


def check_parts(expected: DataFrame, found: DataFrame, key: str, rows: str = "n_rows") -> DataFrame:
    """SRC-18: declared parts that are missing, parts nobody declared, and empty parts."""
    missing = expected.join(found, key, "left_anti").select(key, F.lit("MISSING").alias("problem"))
    extra = found.join(expected, key, "left_anti").select(key, F.lit("UNDECLARED").alias("problem"))
    empty = found.filter(F.col(rows) == 0).select(key, F.lit("EMPTY").alias("problem"))
    return missing.unionByName(extra).unionByName(empty)


def compare_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """SET-1: ids on one side only, with the side; counts and first ids follow from it."""
    left = a.select(key).subtract(b.select(key)).withColumn("side", F.lit("left_only"))
    return left.unionByName(b.select(key).subtract(a.select(key)).withColumn("side", F.lit("right_only")))


def complete_cells(df: DataFrame, rows: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """JN-23: cells of rows x columns that are missing or repeated. Both sides are small lists of samples and targets."""
    expected = rows.crossJoin(F.broadcast(columns))
    counted = expected.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, "left")
    return counted.select(*keys, F.coalesce("n", F.lit(0)).alias("n")).filter("n <> 1")


def grouped_conflicts(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """FLT-27: keys whose repeated rows disagree; equal repeats collapse."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*values)).alias("versions")).filter("versions > 1")


def check_crosswalk(contigs: DataFrame, manifest: DataFrame) -> DataFrame:
    """JN-34: what disagrees between a contig crosswalk and its manifest: assembly_id, check, expected, found.

    Contig count, bases and name prefix of each assembly, and names that repeat in one of three namespaces (query name,
    original header of an assembly, panel name). An empty result means agreement. Contigs: assembly_id, contig_id,
    original_header, panel_name, length; manifest: assembly_id, sample, haplotype, contig_count, total_bases.
    """
    prefixed = contigs.join(manifest.select("assembly_id", F.concat_ws("#", "sample", "haplotype", F.lit("")).alias("_prefix")), "assembly_id", "left")
    totals = prefixed.groupBy("assembly_id").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bp"), F.count_if(~F.coalesce(F.startswith("panel_name", "_prefix"), F.lit(False))).alias("bad"), F.count_if(F.coalesce(F.col("length"), F.lit(0)) <= 0).alias("short"))
    both = manifest.withColumn("_listed", F.lit(True)).join(totals, "assembly_id", "full")
    zero = F.lit(0).cast("long")
    held = lambda c: F.coalesce(F.col(c).cast("long"), zero)
    found = both.select(
        "assembly_id",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(k).alias("check"), expected.alias("expected"), seen.alias("found"))
                    for k, expected, seen in (
                        ("listed", F.lit(1).cast("long"), held("_listed")),
                        ("contig_count", held("contig_count"), held("n")),
                        ("total_bases", held("total_bases"), held("bp")),
                        ("name_prefix", zero, held("bad")),
                        ("empty_contig", zero, held("short")),
                    )
                )
            )
        ).alias("c"),
    ).select("assembly_id", "c.*").filter("expected <> found")
    first_word = F.regexp_extract("original_header", r"^\s*(\S*)", 1)
    names = F.array(
        F.struct(F.lit("query_name").alias("check"), F.concat(F.lit("id="), F.col("assembly_id"), F.lit("|"), F.col("contig_id")).alias("name")),
        F.struct(F.lit("original_name").alias("check"), F.concat_ws("|", "assembly_id", first_word).alias("name")),
        F.struct(F.lit("panel_name").alias("check"), F.col("panel_name").alias("name")),
    )
    repeated = contigs.select("assembly_id", F.explode(names).alias("n")).groupBy("n.check", "n.name").agg(F.min("assembly_id").alias("assembly_id"), F.count(F.lit(1)).alias("found")).filter("found > 1")
    return found.unionByName(repeated.select("assembly_id", "check", F.lit(1).cast("long").alias("expected"), "found"))


def graph_members(*lists: DataFrame) -> DataFrame:
    """SET-2: the union of membership lists, each member once. Rows: graph_id, sample_id."""
    out = lists[0].select("graph_id", "sample_id")
    for more in lists[1:]:
        out = out.unionByName(more.select("graph_id", "sample_id"))
    return out.distinct()


def outer_fill(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """SET-4: rows of either side by key; counts that a side lacks are 0. Keys are equal also where both are null; other columns must differ in name."""
    right = b.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in b.columns if c not in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    values = [c for c in (*a.columns, *b.columns) if c not in keys]
    return a.join(right, same, "full").select(*(F.coalesce(k, f"_{k}").alias(k) for k in keys), *(F.coalesce(c, F.lit(0)).alias(c) for c in values))
