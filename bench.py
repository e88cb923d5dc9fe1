"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one
JSON line.  Each query is fully materialised with the ``noop`` sink (every column computed,
nothing collected to the driver)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from longtab.plans import catalog  # noqa: E402
from longtab.session import get_spark  # noqa: E402

HEADLINE = (
    "aln_filter", "genome_profile", "gene_profile", "collapse_pathway", "cov_intervals",
    "genome_depth", "coverage_consolidate", "feature_merge", "tree_filter", "sample_lookup",
    "audit_steps", "best_bin", "n50", "genome_concat", "read_dedup", "adapter_trim",
    "kmer_screen", "syndna_fit",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, app="longtab-bench")
    # untimed warm-up: JVM start, first codegen, parquet footers
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        catalog.QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
