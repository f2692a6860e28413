"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

One warm-up pass runs every query once; then each query runs three times and the reported
time is the median. A run
executes the whole plan into the ``noop`` sink (no collect to the driver), and the cache is
cleared after every run so that no run reads data persisted by an earlier one. Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["silver_traffic", "feature_mart", "kpi_rollup", "decision_alerts",
            "dedup_events", "row_accounting", "flatten_raw_weather_aqi", "measures_by_location"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from strata.session import get_session
    from strata.plans import driver

    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = get_session(f"local[{cpus}]", app_name="strata-bench", shuffle_partitions=int(cpus),
                        extra_conf={"spark.driver.memory": memory})

    def run_once(name: str) -> float:
        t0 = time.perf_counter()
        driver.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        spark.catalog.clearCache()  # no run may reuse data a previous run persisted
        return elapsed

    for name in names:  # one warm-up pass over every query (JIT, file listings, code caches)
        run_once(name)
    times: dict[str, float] = {}
    for name in names:
        times[name] = round(statistics.median(run_once(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
        "driver_memory": memory,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
