"""Write PLANS.md: the executed (final, after AQE) physical plans of the
flagship catalogue queries.

    python scripts/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spacetime.plans.catalog import QUERIES  # noqa: E402
from spacetime.session import build_session  # noqa: E402

FLAGSHIP = [
    ("hot_cells_top50", "Gi* top-50 on events: one scan, counts exchange reused by the moments subquery"),
    ("hot_cells_clipped", "Gi* with clip=True: grid range pushed into the parquet scan"),
    ("hot_zones", "25 zones: bounding box pushed to the scan, broadcast nested-loop join, partial count"),
    ("hot_zones_tiled", "tile-bucketed broadcast hash join"),
    ("hot_zones_shuffle", "tile-bucketed sort-merge join with salted hot tiles"),
    ("hot_zones_cover_shuffle", "covers: counts and border join read one exchange of the points, one key a point"),
    ("neighbor_sums_box", "neighbourhood sums axis by axis: one shuffle after the counts"),
    ("clustered_cell_range", "a rectangle of cells: key ranges pushed to the scan"),
    ("hot_zones_text", "text input parsed once behind a generator"),
]


def clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)  # expression ids
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    plan = re.sub(r"file:/\S+/", "", plan)
    return plan


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Executed physical plans\n")
    print(f"Final plans (after AQE) of the flagship queries on `{os.path.basename(sf_dir)}`, written by "
          "`scripts/explain_plans.py`.  Expression ids and paths are stripped.\n")
    for name, note in FLAGSHIP:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # small results; runs this DataFrame's own plan to its final form
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        print(f"## `{name}`\n\n{note}.\n\n```\n{clean(buf.getvalue()).rstrip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
