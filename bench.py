"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints
one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: seconds}, "sf"}.
Each query is executed in full through the ``noop`` sink (nothing is collected),
``$BENCH_REPEAT`` times (default 2); ``queries`` reports the fastest run and ``first_run`` the
first one (timings on a shared machine vary by tens of percent between runs).
Set ``BENCH_QUERIES`` (comma-separated) to run a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pinwheel.plans import all_queries  # noqa: E402
from pinwheel.session import get_session  # noqa: E402

HEADLINE = [
    "tx_pairs_all",
    "popularity_grouped",
    "popularity_top_h",
    "popularity_sorted",
    "popularity_report",
    "nearest_center",
    "dist_to_centers",
    "ball_weights",
    "kcenter_metrics",
    "fft_centers",
    "partition_coreset",
    "mr_kcenter_metrics",
    "objective_distinct",
    "objective_partitioned",
    "objective_points",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus) * 2)
    registry = all_queries()
    # Warm the JVM (class loading, parquet reader, codegen) outside the timed region.
    spark.range(1000).selectExpr("sum(id)").collect()
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    nation.join(spark.read.parquet(f"{sf_dir}/region.parquet"), nation.n_regionkey == F.col("r_regionkey")) \
        .groupBy("n_regionkey").count().collect()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        runs = []
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                df = registry[name](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                runs.append(round(time.perf_counter() - t0, 3))
        except Exception as exc:  # noqa: BLE001 - report and keep timing the others
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name], first[name] = min(runs), runs[0]
        print(f"# {name}: {runs}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "first_run": first, "repeat": repeat, "failed": failed,
           "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
