"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS timed runs per query (default 3, median reported), BENCH_WARMUP
(default 1), BENCH_QUERIES (comma list, default the headline set).

Each run executes the full plan with the ``noop`` sink, so the timing covers
scans, shuffles and the final stage without collecting to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

def _driver_memory() -> str:
    """16 GiB, or 60 % of physical memory on a smaller machine."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6) >> 30))}g"


HEADLINE = ["master", "tag_similarity_all", "cohort_profile", "recommend", "segment_top_items"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from playlens.plans.registry import QUERIES
    from playlens.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 4 * cpus))),
                          app_name="playlens-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", _driver_memory())})
    spark.sparkContext.setLogLevel("ERROR")

    timings: dict[str, float] = {}
    for name in names:
        spark.sparkContext._jvm.System.gc()  # start each query from a collected heap
        fn = QUERIES[name]
        samples = []
        for i in range(warmup + runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i >= warmup:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
