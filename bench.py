"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from readsift.checks import catalog  # noqa: E402
from readsift.checks.search_queries import proteins  # noqa: E402
from readsift.checks.views import STORED, view  # noqa: E402

QUERIES = [
    "species_share", "merged_report", "virus_append_stages", "seq_found", "seq_notfound", "additional_input",
    "fastq_invalid", "merge_keep_unmerged", "adapter_trim", "adapter_file_trim", "cut_right", "qc_chain", "qc_stats", "fastq_roundtrip",
    "model_chunks", "taxon_lineage", "kmer_index", "translate6", "host_subtract", "search_nt", "search_blastx",
    "search_blastx_fast", "cluster_centroids",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("readsift-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.time()
    for name in sorted(STORED):
        view(spark, sf_dir, name)
    proteins(spark, sf_dir)
    setup = time.time() - t0
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        t0 = time.time()
        # every row and column is computed; nothing is sent to the driver
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - t0, 2)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 2), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "setup_sec": round(setup, 2),
    }))


if __name__ == "__main__":
    main()
