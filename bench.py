"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full with the ``noop`` sink (no driver collect); the time is
wall-clock per query after one warm-up query on the same session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkledger.plans.catalog import queries  # noqa: E402
from sparkledger.session import local_session  # noqa: E402

HEADLINE = [
    "gold_metrics", "silver_build", "assurance_join", "open_layer", "rejection_reasons",
    "quarantine_split", "dedup_latest", "run_summary", "upsert_latest", "upsert_hash_gated",
    "scalar_functions", "conform_columns", "row_policy", "column_policy", "csv_scan",
    "file_manifest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")),
                          app="sparkledger-bench")
    qs = queries()
    # Warm-up, not timed: JIT, class loading and generated-code compilation, done on the
    # smallest tables (same plans, none of the measured data).
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("gold_metrics", "assurance_join"):
        qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if not sys.argv[1:] and warm_dir != sf_dir:
        # the fixed cost of a run: some 330 small files, about 15 rows each
        t0 = time.perf_counter()
        qs["file_manifest"](spark, warm_dir).write.format("noop").mode("overwrite").save()
        times["small_file_manifest"] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
