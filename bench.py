"""Benchmark of the headline jobs; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     threads (default: all)
BENCH_QUERIES  comma-separated subset of query names
BENCH_RUNS     timed runs per query after a warm-up on smaller data (default 1); the best counts
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "A01_grid_summary", "A02_tile_index", "A11_grid_coverage", "A15_robust_bounds", "A17_tile_pyramid",
    "W06_drop_rate_thinning", "C21_conform", "E01_process_source", "W01_latest_runs_to_date", "W03_source_history",
    "W05_usage_rates", "J08_shared_borders", "J11_reuse_previous_run", "A10_coverage_summary", "A13_license_text",
    "U01_touched_files", "E02_collect_extracts", "E03_index_tiles", "E04_dot_map", "E05_calculate_coverage",
    "E06_dashboard", "E07_coverage_geojson", "E10_batch_plan", "T03_done_or_due",
]


def main() -> None:
    from streetgrain import catalog
    from streetgrain.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus))
    queries = catalog.queries()

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    warm = small if os.path.isdir(small) else sf_dir

    def timed(name: str, folder: str) -> float:
        start = time.time()
        # Every column of every row is computed, nothing is kept.
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.time() - start

    timings: dict[str, float] = {}
    for name in names:
        timed(name, warm)
        timings[name] = round(min(timed(name, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    report = {
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
        "conform_rows": lines,
        "conform_rows_per_sec": {
            n: round(lines / timings[n]) for n in ("C21_conform", "E01_process_source") if n in timings
        },
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
