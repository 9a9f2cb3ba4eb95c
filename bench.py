"""Time every registered query and print one JSON line.

Environment: `BENCH_SF_DIR` (tables), `BENCH_CPUS` (cores), `BENCH_RUNS` (runs per query, the fastest
counts), `BENCH_QUERIES` (names, comma-separated; all by default).  Results go to Spark's `noop` sink, so
that every row and column is computed.
"""

import json
import os
import sys
import time

from testbed.compare import session
from testbed.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
NAMES = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session(CPUS)
    for _ in range(3):  # start-up, class loading and compilation do not count
        seconds(spark, "hourly_wide")
    times = {}
    for name in NAMES:
        times[name] = round(min(seconds(spark, name) for _ in range(RUNS)), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total wall time of all queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
