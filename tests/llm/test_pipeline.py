"""The pipeline's stages: what goes, what stays, and that every decision takes effect."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortspan.llm import pii, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    current, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in current.select("doc_id").collect()}
        current = stage(spark, current, SF).checkpoint()
        assert current.columns == docs.columns
        kept[name] = {r.doc_id for r in current.select("doc_id").collect()}
        assert kept[name] <= before
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert len(kept["language_id"] & good) == len(good)
    assert len(kept["quality_classifier"] & good) >= 0.97 * len(good)
    deduped = simhash.classes(docs.filter(F.col("doc_id").isin(list(kept["near_duplicates"]))))
    assert deduped.groupBy("component_id").count().filter("count > 1").count() == 0
    assert current.filter(F.size(pii.base_spans(F.col("text"))) > 0).count() == 0
    assert current.filter(F.char_length("text") != F.col("n_chars")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, current, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept["personal_data"] and names[-1] == "best_fit_packing"
    assert sorted(map(tuple, packed.drop("sequence_id", "offset").collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()))
