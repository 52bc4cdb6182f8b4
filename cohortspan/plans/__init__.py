"""Named queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> tuple[dict, dict]:
    """Queries and SQL by name."""
    from . import queries_assembly, queries_catalog, queries_cohort, queries_inputs, queries_review  # noqa: F401  they register themselves
    from .registry import ORACLES, QUERIES

    return QUERIES, ORACLES


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_queries()[0]["agg_8_contamination_summary"](spark, sf_dir)
