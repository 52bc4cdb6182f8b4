"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's spark.checkpoint.dir. Where none is set, one machine alone gets a folder of its own; a cluster is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there: computed once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that writes a table as Parquet to a folder in the shared checkpoint folder and reads it again: lineage cut, columns
    and rows pruned when read. The folder goes at the end; what is returned by then must be materialised."""
    ensure_checkpoint_dir(spark)
    jvm, folder = spark._jvm, f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/scratch-{uuid.uuid4().hex}"
    number = count()

    def keep(df: DataFrame) -> DataFrame:
        own = f"{folder}/{next(number)}"
        df.write.parquet(own)
        return spark.read.schema(df.schema).parquet(own)

    try:
        yield keep
    finally:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_arrow() -> None:
    """Give memory that Arrow holds for later back to the machine: a Python worker lives on from stage to stage."""
    pa.default_memory_pool().release_unused()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id) -> "F.Column":
    """Documents whose crc32(doc_id as text) mod 4 is 2 are never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def number_within(df: DataFrame, group: str, name: str) -> DataFrame:
    """Add `name`: 0, 1, 2, ... inside each value of `group`, in the order in which `df` holds its rows.

    `df` must read a materialised table through narrow steps only: then a row's partition and place are fixed. A group can
    hold a third of all rows, so it is never one window: rows are numbered inside (group, partition), however alike they are,
    and each partition starts where the counts of those before it end. The table of counts has a row a group and partition.
    """
    keyed = df.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    counts = keyed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_start"))
    inner = F.row_number().over(Window.partitionBy(group, "_part").orderBy("_row")) - 1
    return (
        keyed.withColumn("_inner", inner)
        .join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
        .withColumn(name, (F.col("_start") + F.col("_inner")).cast("long"))
        .drop("_part", "_row", "_inner", "_g", "_p", "_start")
    )
