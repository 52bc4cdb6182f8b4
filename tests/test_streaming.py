"""The streaming functions on a stream of files give what they give on a batch."""

from pyspark.sql import functions as F

from cohortspan.plans.adapters import frame
from cohortspan.streaming import metrics

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    gaf = frame(spark, SF, "gaf")
    gaf.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(gaf.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = metrics.mapping_histogram(stream).writeStream.outputMode("complete").format("memory").queryName("histogram").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    key = ["sample_id", "target"]
    assert metrics.mapping_figures(spark.table("histogram")).orderBy(*key).collect() == metrics.mapping_figures(metrics.mapping_histogram(gaf)).orderBy(*key).collect()
    targets = spark.createDataFrame([("g0", "A", "left", ">s3>s4"), ("g1", "A", "right", ">s5>s6")], "target string, allele string, feature string, edge string")
    q = metrics.stream_fragment_support(stream, targets).writeStream.outputMode("complete").format("memory").queryName("support").option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("support").agg(F.sum("fragments")).first() == metrics.stream_fragment_support(gaf, targets).agg(F.sum("fragments")).first()


def test_fragments_are_forgotten_behind_the_watermark(spark, tmp_path):
    """Repeats within the delay count once, also over batches; state holds no fragment of long ago."""
    aln = "sample_id string, target string, read_name string, path string, mapq int, is_secondary boolean, block long, seen timestamp"
    targets = spark.createDataFrame([("g0", "A", "left", ">s3>s4")], "target string, allele string, feature string, edge string")
    for hour in range(8):
        rows = [("p", "g0", f"r{hour}_{i // 2}", ">s3>s4", 60, False, 10, f"2024-01-01 {hour:02}:{i:02}:00") for i in range(40)]
        stamped = spark.createDataFrame(rows, aln.replace("timestamp", "string")).withColumn("seen", F.to_timestamp("seen"))
        stamped.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(aln).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    support = metrics.stream_fragment_support(stream, targets, event_time="seen", delay="30 minutes")
    q = support.writeStream.outputMode("update").format("memory").queryName("bounded").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    last = [p for p in q.recentProgress if p["stateOperators"]][-1]
    q.stop()
    assert spark.table("bounded").agg(F.max("fragments")).first()[0] == 8 * 20
    assert sum(o["numRowsTotal"] for o in last["stateOperators"]) <= 2 * 20 + 1
    whole = spark.read.schema(aln).parquet(str(tmp_path / "in"))
    assert metrics.stream_fragment_support(whole, targets, event_time="seen").first().fragments == 8 * 20
