"""A corpus pipeline of five stages: language ID, quality, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
rejected document goes, a clean one stays; of a group of near-duplicates the document with the smallest id stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspan.llm import packing, pii, ppm_langid, quality, simhash
from cohortspan.llm.common import ensure_checkpoint_dir, held_out
from cohortspan.llm.queries import RANKS, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those that the best tree codes worse than plain bytes. A text that two learned languages
    fit alike is in one of them and stays, whatever the share of the better one."""
    model = ppm_langid.learn(docs.filter(~held_out(F.col("doc_id"))))
    found = ppm_langid.predict(docs, model, docs.columns)
    return found.filter((F.col("lang_pred") != "und") & ppm_langid.plausible()).select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.classify(docs, table(spark, sf_dir, "labels"), keep=docs.columns).filter("predicted = 1").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find(docs).withColumn("text", F.col("pii_text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, RANKS, keep_ids=False)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the trained stages or token ids; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared checkpoint folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
