"""Benchmark the headline queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 4).  Each query runs once to warm up (the
first run also lands the shared lake), then three timed runs; a run is
fully computed through the ``noop`` sink, so no rows go to the driver.
Prints one JSON line with the median seconds per query and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["gold_results", "dq_null_by_file", "queue_apply_run",
            "land_partitioned_3key", "medallion_wap", "medallion_transform",
            "medallion_full", "response_json", "log_scan_parse", "queue_next_batch"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from tierline import checks
    from tierline.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="tierline-bench",
                          shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = checks.queries()
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    def once(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    medians: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name in names:
        warm[name] = round(once(name), 3)
        medians[name] = round(statistics.median(once(name) for _ in range(repeats)), 3)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_query_median_sum",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "warmup": warm,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
