"""Run the analyses with injected task failures (used by test_fault_tolerance.py).

Prints OK when results with failed-and-retried tasks equal the fault-free ones.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from spacetime.operators.gistar import hot_cells  # noqa: E402
from spacetime.operators.zones import hot_zones  # noqa: E402
from spacetime.plans.catalog import EV_GRID  # noqa: E402
from spacetime.session import build_session  # noqa: E402
from spacetime.sources.tables import events_points, lineitem_points, nation_zones  # noqa: E402


def _fail_first_attempt(_):
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 0:
        raise RuntimeError("injected task failure")
    return True


def main(sf_dir):
    spark = build_session("local[4,3]", app="spacetime-faults", shuffle_partitions=4)
    fail_first_attempt = F.udf(_fail_first_attempt, "boolean")
    li = lineitem_points(spark, sf_dir)
    ev = events_points(spark, sf_dir)
    nz = nation_zones(spark, sf_dir)
    opts = dict(strategy="tiled_shuffle", salt=4)

    want_z = sorted(tuple(r) for r in hot_zones(li, nz, **opts).collect())
    want_c = [tuple(r) for r in hot_cells(ev, EV_GRID, k=50, with_score=True).collect()]

    # failure in the scan stage
    got_z = sorted(tuple(r) for r in hot_zones(li.filter(fail_first_attempt("px")), nz, **opts).collect())
    got_c = [tuple(r) for r in hot_cells(ev.filter(fail_first_attempt("px")), EV_GRID, k=50, with_score=True).collect()]
    # failure after the shuffles (the retried task re-reads shuffle output)
    got_z2 = sorted(tuple(r) for r in hot_zones(li, nz, **opts).filter(fail_first_attempt("value")).collect())

    assert got_z == want_z and got_z2 == want_z, "zone counts differ after retries"
    assert got_c == want_c, "hot cells differ after retries"
    spark.stop()
    print("OK")


if __name__ == "__main__":
    main(sys.argv[1])
