"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores.  Each query runs once to warm up and then ``BENCH_RUNS`` times (default
2) into the noop sink; the median counts.  Times include building the plan,
with all jobs that takes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINES = (
    "document_records", "tag_departments", "publish_records", "dedupe_requests",
    "not_seen_final", "complete_zips", "upsert_documents", "upload_limit",
    "download_links", "walk_to_files", "zip_members", "monitor_run",
)


def main() -> None:
    from checks.compare import session
    from checks.queries import QUERIES

    spark = session(CPUS)
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    times = {}
    for name in names:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds, headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
