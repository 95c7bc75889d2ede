"""Time the queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data
and the local cores; BENCH_QUERIES may list names. Every query runs to the end with its
rows discarded. The per-query time includes planning and the small layout jobs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge import plans  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = plans.all_queries()
    names = os.environ.get("BENCH_QUERIES", "").split() or list(queries)
    spark = local_session(cpus, "bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries["default_key"](spark, sf_dir).count()  # start the executors
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
