"""Times the headline jobs and prints one JSON line.

Each job writes to a `noop` sink, so the whole result is computed and nothing is collected. All jobs
run once to warm up and are then timed; jobs that write intermediate tables do so inside the timed run.
"""

from __future__ import annotations

import json
import os
import time

from feira.plans.star_queries import QUERIES
from feira.session import local_session

HEADLINE = [
    name
    for name in QUERIES
    if name.startswith(("m1", "m2", "m3", "m4", "m5", "m6", "m7", "m8", "c1", "c2", "c3", "x1"))
]


def seconds(spark, job, folder: str) -> float:
    begin = time.perf_counter()
    job(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores), memory="12g")
    for name in HEADLINE:
        seconds(spark, QUERIES[name], folder)
    times = {name: round(seconds(spark, QUERIES[name], folder), 3) for name in HEADLINE}
    spark.stop()
    result = {
        "metric": "headline jobs, wall time after one warm-up",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
