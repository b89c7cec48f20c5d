"""Seconds per headline query; prints one JSON line.

Each query runs RUNS times over the whole tables into a no-op sink; plan building and size checks count.
The best run is reported.
"""

from __future__ import annotations

import json
import os
import time

from rotorlake.session import local_session
from workload.queries import QUERIES

HEADLINE = [
    "kv_parse",
    "range_clean",
    "feature_staging",
    "ideal_power",
    "standard_mapping",
    "avg_10m",
    "im_flags",
    "im_calc",
    "state_seconds",
    "energy_seconds",
    "production_base",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
