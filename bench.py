"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed fully through the `noop` sink (the whole plan runs, nothing is
collected to the driver), $BENCH_RUNS times (default 3); the median is reported, the
spread (slowest minus fastest), and the first runs with their total: those compile, and write
the stored tables that later runs read.
Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "first_total": N, "first": {...}, "spread": {...}, "sf": ...}
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in sys.argv[1:] if q]

    from metrolens.plans.catalog import QUERIES
    from metrolens.session import build_session

    spark = build_session(master=f"local[{cpus}]", app="metrolens-bench", shuffle_partitions=cpus)
    # warm-up: JVM, file listing, codegen caches
    QUERIES["weather_basic"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    spread: dict[str, float] = {}
    first: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(median(runs), 3)
        first[name] = round(runs[0], 3)
        spread[name] = round(max(runs) - min(runs), 3)
        # drop this query's frames so Spark's cleaner can remove its checkpoint files
        gc.collect()
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "first_total": round(sum(first.values()), 3), "first": first, "spread": spread, "sf": sf,
                      "runs_per_query": RUNS, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
