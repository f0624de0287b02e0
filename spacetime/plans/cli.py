"""Command-line front-end for the batch runner.

    spark-submit spacetime/plans/cli.py --output out/report \\
        --query hotzoneanalysis points.csv rectangles.tsv \\
        --query hotcellanalysis points.csv

Each ``--query NAME PATH...`` becomes one entry of
:func:`spacetime.plans.jobs.run_batch`; the k-th query's report goes to
``OUTPUT + k``.  The session comes from ``spark-submit`` (or a local one when
run directly).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from spacetime.plans.jobs import QUERIES, run_batch  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Run hot-zone / hot-cell analyses and write CSV reports.")
    p.add_argument("--output", required=True, help="output path prefix; query k writes to PREFIX + k")
    p.add_argument("--query", nargs="+", action="append", required=True, metavar=("NAME", "PATH"),
                   help=f"query name ({', '.join(sorted(QUERIES))}) followed by its input path(s)")
    p.add_argument("--single-file", action="store_true", help="write each report as one file, through one task")
    p.add_argument("--shared-scan", action="store_true", help="read a point file once for two neighbouring queries of both kinds")
    return p.parse_args(argv)


def main(argv=None) -> list[str]:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("spacetime-batch").getOrCreate()
    return run_batch(spark, args.output, [(q[0], q[1:]) for q in args.query], args.single_file, args.shared_scan)


if __name__ == "__main__":
    for path in main():
        print(path)
