"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

import workload  # noqa: E402
from foldergrid.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="foldergrid-") as shared:
        run(local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8, **{"spark.checkpoint.dir": shared}))


def run(spark) -> None:
    queries = workload.queries()
    names = sys.argv[1:] or list(queries)
    # start the JVM's code paths and the file cache before anything is timed
    queries["file_catalog_filter"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
