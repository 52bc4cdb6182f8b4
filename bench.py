"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with wall seconds.

The first query runs once more before the others, so that classes are loaded. Results go to Spark's noop sink, so every
column is computed and nothing is collected. The same SQL in DuckDB is timed beside it, where the library is there and a query ends within
DUCKDB_SECONDS (null otherwise); BENCH_DUCKDB=0 leaves that out.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import threading
import time

from pyspark.sql import SparkSession

from cohortspan.plans import all_queries

HEADLINE = (
    "agg_8_contamination_summary", "agg_3_alignment_summary", "flt_3_contig_interval_decision", "agg_13_callable_fraction", "scl_7_cigar_events", "win_3_greedy_clusters", "agg_24_catalog_rows",
    "jn_9_breakpoint_band_join", "jn_5_overlap_join", "jn_6_nearest_all_ties", "agg_9_mapping_metrics_input", "agg_30_fragment_support", "agg_37_stratified_summary", "agg_18_graph_overview",
    "gr_1_reference_chromosome", "jn_12_locate_on_path",
)


DUCKDB_SECONDS = 10


def duckdb_seconds(sf_dir: str, names: tuple[str, ...], threads: str) -> dict[str, float | None]:
    try:
        import duckdb
    except ImportError:
        return {}
    con, out, oracles = duckdb.connect(), {}, all_queries()[1]
    con.execute(f"set threads = {int(threads)}")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    for name in names:
        if name not in oracles:
            continue
        stop = threading.Timer(DUCKDB_SECONDS, con.interrupt)
        stop.start()
        began = time.time()
        try:
            con.execute(oracles[name]).fetchnumpy()
            out[name] = round(time.time() - began, 3)
        except duckdb.Error:
            out[name] = None
        finally:
            stop.cancel()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    local = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", local)
        .config("spark.sql.warehouse.dir", f"{local}/warehouse")
        .config("spark.checkpoint.dir", f"{local}/checkpoint")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries()[0], {}
    for name in (HEADLINE[0], *HEADLINE):
        began = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    beside = {} if os.environ.get("BENCH_DUCKDB") == "0" else duckdb_seconds(sf_dir, HEADLINE, cpus)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"), "duckdb": beside}))


if __name__ == "__main__":
    main()
