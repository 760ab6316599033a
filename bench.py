"""Benchmark: every registered query at one scale factor.

Each query is built and then executed in full through the ``noop`` sink (the
whole plan runs, nothing is collected to the driver). Jobs that write data as
part of the query (bronze round trip, marts, snapshots) include those writes,
and the time to build a query (inference, size checks) is counted too.

Before timing, every query runs once, untimed, on the smallest tables
(``BENCH_WARMUP_DIR``, a different scale from the one measured, so nothing of
the measured input is cached): this loads classes and JIT-compiles the JVM
code paths, as a long-running cluster job has done after its first seconds.
``BENCH_WARMUP=0`` turns it off. Each query is then timed ``BENCH_REPEAT``
times (default 3), built from scratch every time so no shuffle output or plan
is reused, and its median is reported. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))

    from tessera.session import build_session

    spark = build_session(
        master=f"local[{cpus}]",
        app_name="tessera-bench",
        shuffle_partitions=cpus,
        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")

    from tessera.queries import REGISTRY

    # JVM warm-up (class loading, JIT), not timed: every query once on the
    # tiny smoke tables, a different scale from the one measured.
    smoke = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm = os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(smoke) and smoke.rstrip("/") != sf_dir
    warmup_sec = 0.0
    if warm:
        start = time.perf_counter()
        for name, (fn, _) in REGISTRY.items():
            if only and name not in only:
                continue
            fn(spark, smoke).write.format("noop").mode("overwrite").save()
        warmup_sec = round(time.perf_counter() - start, 3)

    timings: dict[str, float] = {}
    for name, (fn, _) in REGISTRY.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeat):
            start = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs), 3)

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeat": repeat,
                "stat": "median",
                "warmup": {"dir": smoke if warm else None, "sec": warmup_sec},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
