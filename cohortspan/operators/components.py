"""What several operators share beyond column expressions: stored tables, running totals over ranges, connected components."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where none is set, one machine alone gets a folder of its own; a cluster is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def saved(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder: computed once, lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def running_totals(df: DataFrame, order: list, totals: dict[str, str]) -> DataFrame:
    """`df` with a running sum for each of `totals` (name: column) up to and including each row, over the whole table in this order.

    Rows are sorted into ranges; each range sums by itself and starts where the sums of those before it end. No two rows may tie.
    """
    ranged = saved(df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)).withColumn("_part", F.spark_partition_id())
    sums = ranged.groupBy("_part").agg(*(F.sum(c).alias(f"_sum_{name}") for name, c in totals.items()))  # a row a range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", *(F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_from_{name}") for name in totals))
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({name: F.sum(c).over(own) for name, c in totals.items()}).join(F.broadcast(starts), "_part")
    return summed.withColumns({name: F.col(name) + F.col(f"_from_{name}") for name in totals}).drop("_part", *(f"_from_{name}" for name in totals))


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the smallest node around it."""
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are joined to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge: root is the smallest node of its component.

    Large-star and small-star rounds (logarithmic in the longest chain) until nothing changes; the edges of each
    round are checkpointed. Null ends and self-loops are left out. A node's edges are never gathered in one row.
    """
    current = saved(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a <> b").distinct())
    mark = _mark(current)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        current = saved(_small_star(_large_star(current)))
        before, mark = mark, _mark(current)
        if before == mark:
            break
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
