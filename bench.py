"""Benchmark the headline queries.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1):
one warm-up run of every query, then the median of $BENCH_REPS (default 3) timed
runs, each ending in a ``noop`` write so the whole plan executes. Prints ONE JSON
line: {"metric", "value" (sum of medians), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "C1_key_segments",          # static refresh: division, shapes join, windows
    "C1_trip_segments",
    "C3_weekly_training_set",   # flagship: match, date parts, averages, lags, target
    "C2_realtime_ingest",       # JSON parse, validation, last-wins, merge
    "C4_profile_table",         # profile over the analytics table
    "A15_describe",
    "A17_corr_matrix",
    "A20_hexbin_density",
    "J7_segment_match",
    "D4_candidate_trips",
]


def _default_memory() -> str:
    """Local mode runs everything in the driver JVM: give it ~60% of RAM, at most 16 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(2, min(16, int(total * 0.6 / 2**30)))}g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from waka.plans import catalog_profile
    from waka.plans.catalog import QUERIES
    from waka.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, int(cpus) * 2), app="waka-bench",
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", _default_memory()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))

    def run(key: str) -> float:
        catalog_profile._STORED.clear()   # each run rebuilds the analytics table it profiles
        spark.catalog.clearCache()        # and every frame that an earlier run persisted
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for key in HEADLINE:
        run(key)  # warm-up
        times[key] = round(statistics.median(run(key) for _ in range(reps)), 3)
        print(f"{key}: {times[key]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({"metric": "headline_queries_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_val}))
    spark.stop()


if __name__ == "__main__":
    main()
