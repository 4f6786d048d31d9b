"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores;
BENCH_RUNS (default 3) the timed runs of each query after one warm-up. Results go to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks import QUERIES
from checks.compare import session

HEADLINE = [
    "validate_deals", "transform_deals", "enrich_deals", "enrich_deals_large_dims", "sync_deals", "latest_per_id", "merge_deals",
    "merge_deals_small_source", "first_stage_entry", "stage_history_wide", "fill_stage_history", "backfill_stage_history",
    "normalize_name", "normalize_endpoint", "flatten_custom_fields", "reconcile_ids", "field_mismatches", "data_quality_report",
    "token_cost_by_endpoint", "duration_histogram", "histogram_quantile", "exact_quantiles", "counter_increase",
    "batch_quality", "score_runs_balanced", "batch_size_advice", "page_chain_audit",
    "sliding_increase", "stage_transitions", "reconcile_unique_ids", "field_mismatches_by_range",
]


def seconds(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
