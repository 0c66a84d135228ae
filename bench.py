"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores, ``BENCH_RUNS`` the
number of timed runs (the median counts), ``BENCH_QUERIES`` another comma-separated selection, or
``all``.  Every run produces all rows of all columns and discards them.
"""

import json
import os
import statistics
import sys
import time

from suite.check import local_session
from suite.registry import QUERIES, run


HEADLINE = [
    "split_multiallelic", "lookup_mpc", "lookup_many",
    "csq_repack", "lookup_loeuf", "gene_list_many", "spliceai_gated",
    "interval_annotate", "region_overlap", "pl_collapse", "call_stats", "merge_samples",
    "contig_shards", "vcf_text_genotypes",
    "annotate_vcf", "annotate_extra_dev",
]


def timed(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cores, partitions=2 * cores)
    times = {}
    for name in names:
        timed(name, spark, sf_dir)  # warm-up
        times[name] = round(statistics.median(timed(name, spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").split("/sf")[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
