"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs every catalogue query once to warm up, then ``BENCH_REPS`` timed runs
(median kept).  Each run executes the whole plan into Spark's ``noop`` sink
(nothing is collected to the driver).  Prints ONE JSON line:
``{"metric", "value", "unit", "queries", "sf", ...}`` where ``value`` is the
sum of the headline query medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spacetime.plans.catalog import QUERIES  # noqa: E402
from spacetime.session import build_session  # noqa: E402

# The two analyses, each in its main variants.
HEADLINE = [
    "hot_zones",
    "hot_zones_tiled",
    "hot_zones_text",
    "zone_point_pairs",
    "gi_star_lineitem",
    "hot_cells_top50",
    "hot_cells_lineitem_top50",
    "hot_cells_text",
    "hot_cells_default_grid",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(QUERIES)
    spark = build_session(f"local[{cpus}]", app="spacetime-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g"})
    times, errors = {}, {}
    for name in names:
        fn = QUERIES[name]
        try:
            run_once(spark, fn, sf_dir)  # warm-up
            times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 4)
        except Exception as e:  # keep measuring the rest; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    spark.stop()
    head = [q for q in HEADLINE if q in times] or list(times)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_query_seconds_sum",
        "value": round(sum(times[q] for q in head), 4),
        "unit": "sec",
        "queries": times,
        "headline": head,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "reps": reps,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
