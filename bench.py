"""Benchmark: run every registered query over $BENCH_SF_DIR and print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is computed,
nothing is collected to the driver). Usage:
    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holdwise.plans.registry import QUERIES  # noqa: E402
from holdwise.session import local_session, pin_time_zone  # noqa: E402

HEADLINE = "fact_daily_ownership"


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 4 * cpus), app="holdwise-bench")
    pin_time_zone(spark)
    names = argv or list(QUERIES)

    # Warm the JVM (class loading, codegen caches) on the smallest data set.
    QUERIES[HEADLINE](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()  # no query may profit from another one's persisted data
        print(f"# {name}: {timings[name]} s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
