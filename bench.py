"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is written to Spark's ``noop`` sink (full execution, no output I/O):
one warm-up run, then the median of $BENCH_RUNS timed runs.  ``queries`` holds
``mart_build`` (the dashboard's base written once to the shared folder) and the
views over that written base, as the dashboard reads it; ``lazy`` holds some
views as they are registered, the base computed inside each (all views share that
base, which is most of their time).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

LAZY = ("kpis", "party_author_tree", "latest_rows", "facet_options")

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("plenaria-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8"))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             # no per-call Python call-site capture (error context only) while building plans
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        import tempfile   # local run only: a cluster names its shared folder in spark.checkpoint.dir
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plenaria-bench-"))

    from plenaria.catalog import QUERIES, VIEWS, mart_table
    from plenaria.sources.stages import written

    def timed(name: str, build, n: int) -> float:
        """Median seconds of ``n`` runs after a warm-up run."""
        samples, builds = [], []
        for i in range(n + 1):
            t0 = time.time()
            df = build()
            t1 = time.time()
            df.write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.time() - t0)
                builds.append(t1 - t0)
        median = round(statistics.median(samples), 3)
        print(f"{name:26s} {median:7.3f}s (plan build {statistics.median(builds):.3f}s)", file=sys.stderr, flush=True)
        return median

    times: dict[str, float] = {}
    lazy: dict[str, float] = {}
    total_start = time.time()
    for name, fn in QUERIES.items():
        if name not in VIEWS and (not only or name in only):
            times[name] = timed(name, lambda: fn(spark, data), runs)
    builds = []
    for _ in range(2):
        t0 = time.time()
        base = written(mart_table(spark, data), "bench-mart")
        builds.append(time.time() - t0)
    times["mart_build"] = round(builds[-1], 3)
    for name, view in VIEWS.items():
        if not only or name in only:
            times[name] = timed(name, lambda: view(base), runs)
    for name in LAZY:
        if not only or name in only:
            lazy[name] = timed(f"{name} (lazy)", lambda: QUERIES[name](spark, data), 1)
    m = re.search(r"sf([0-9.]+)$", data)
    print(json.dumps({
        "metric": "sum_of_query_median_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "lazy": lazy,
        "sf": float(m.group(1)) if m else data,
        "cpus": cpus,
        "runs": runs,
        "wall_sec": round(time.time() - total_start, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
