"""Bench: wall time per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

One warm-up run, then the median of three.  Each query is run to the end
with the ``noop`` sink (all rows computed, nothing sent to the driver).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadlens.registry import QUERIES  # noqa: E402
from roadlens.session import build_session  # noqa: E402

HEADLINE = list(QUERIES)


def run_once(spark, name, sf_dir):
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), extra={"spark.checkpoint.dir": shared})
    out = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        out[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    spark.stop()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    mem_gb = round(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2 ** 30, 1)
    print(json.dumps({"metric": "total_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "memory_gb": mem_gb, "reps": reps}))


if __name__ == "__main__":
    main()
