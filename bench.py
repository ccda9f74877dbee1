"""Benchmark every registered query.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed to
completion into Spark's ``noop`` sink (the whole plan runs, nothing is
collected to the driver); the reported time is the median of
``$BENCH_RUNS`` runs (default 3) after one untimed warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tessera.plans.registry import queries
    from tessera.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="tessera-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = queries()
    names = only or list(qs)
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = qs[name]
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # first run warms up code generation and the file cache
                    samples.append(time.perf_counter() - t0)
        except Exception as e:  # report and go on: one JSON line in any case
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        timings[name] = round(statistics.median(samples), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
