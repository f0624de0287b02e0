import math
import os
import random

import pytest
from pyspark.sql import functions as F

from spacetime.functions.grid import GridSpec
from spacetime.operators.cells import assign_cells, cell_counts
from spacetime.operators.onepass import OnePass
from spacetime.operators.zones import hot_zones
from spacetime.plans import jobs
from spacetime.plans.cli import parse_args
from spacetime.sources.csv import read_points_csv, read_rectangles_csv, read_report, write_points_csv, write_rectangles_csv

SPEC = GridSpec(min_x=-5, max_x=5, min_y=-5, max_y=5, min_z=1, max_z=31, step_x=2.0, step_y=3.0)
BOTH = [("hotzoneanalysis", 2), ("hotcellanalysis", 1)]


def frames(spark, seed, n=3000, n_zones=80):
    r = random.Random(seed)
    points = [(r.gauss(0, 4), r.gauss(0, 6), f"2009-01-{r.randint(1, 31):02d} 10:00:00") for _ in range(n)] + [(math.nan, 0.0, "2009-01-01 00:00:00"), (0.0, math.nan, None), (1e9, -1e9, "2009-01-02 00:00:00"), (1.0, 1.0, None)]
    pts = spark.createDataFrame(points, "px double, py double, s string").select("px", "py", F.to_timestamp_ntz("s").alias("t"))
    zones = []
    for i in range(n_zones):
        x, y, w = r.gauss(0, 5), r.gauss(0, 5), 10 ** r.uniform(-2, 1.5)
        zones.append((f"z{i % 60}", -math.inf if i % 9 == 0 else x, y, x + w, math.inf if i % 7 == 0 else y + w * r.random()))
    return pts, spark.createDataFrame(zones, "rectangle string, x1 double, y1 double, x2 double, y2 double")


@pytest.mark.parametrize("opts", [{}, {"max_level": 2}, {"cells_per_zone": 1, "spare_cells": 0}])
def test_counts_equal_those_of_two_passes(spark, opts):
    pts, zones = frames(spark, 1)
    one = OnePass(pts, zones, SPEC, **opts)
    counts = one.counts.cache()
    try:
        want = hot_zones(pts, zones, strategy="tiled_broadcast").collect()
        assert one.zone_counts(counts).collect() == want
        cells = {tuple(r) for r in cell_counts(assign_cells(pts, SPEC), SPEC).collect()}
        assert {tuple(r) for r in one.cell_counts(counts).collect()} == cells
    finally:
        counts.unpersist()


def test_too_many_border_cells_are_refused(spark):
    pts, zones = frames(spark, 2, 50)
    with pytest.raises(ValueError, match="one pass needs"):
        OnePass(pts, zones, SPEC, broadcast_max_bytes=100)


def files(spark, scratch, seed=3):
    r = random.Random(seed)
    points = os.path.join(scratch, "points")
    rects = os.path.join(scratch, "rects")
    rows = [(f"({-74.5 + r.random():.6f},{40.5 + r.random() / 2:.6f})", f"2009-01-{r.randint(1, 31):02d} 10:00:00") for _ in range(800)]
    write_points_csv(spark.createDataFrame(rows, "point string, pickup_time string"), points)
    zones = [(f"-74.{i % 5},40.{50 + i},-73.{9 - i % 5},41.{i}", 'a,\t"b"') for i in range(12)]
    write_rectangles_csv(spark.createDataFrame(zones, "rectangle string, remark string"), rects, extra=("remark",))
    return points, rects, rows, zones


def test_files_read_as_written(spark, scratch):
    points, rects, rows, zones = files(spark, scratch)
    assert sorted((r.point, r.pickup_time) for r in read_points_csv(spark, points).collect()) == sorted(rows)
    assert sorted(r.rectangle for r in read_rectangles_csv(spark, rects).collect()) == sorted(z[0] for z in zones)


def test_one_scan_of_the_point_file(spark, scratch):
    points, rects, *_ = files(spark, scratch)
    counts = jobs.shared_counts(spark, points, rects).counts
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan csv" in line]
    assert sum(f"{points}" in line for line in scans) == 1
    assert plan.count("HashAggregate") >= 2 and "Python" not in plan


@pytest.mark.parametrize("order", [[0, 1], [1, 0]])
def test_a_shared_batch_writes_the_same_reports(spark, scratch, order, monkeypatch):
    points, rects, *_ = files(spark, scratch)
    queries = [[("hotZoneAnalysis", [points, rects]), ("hotcellanalysis", [points])][i] for i in order] + [("hotcellanalysis", [points])]
    apart = jobs.run_batch(spark, os.path.join(scratch, "apart"), queries)
    taken = []
    real = jobs.shared_analyses
    monkeypatch.setattr(jobs, "shared_analyses", lambda *a, **k: taken.append(a) or real(*a, **k))
    shared = jobs.run_batch(spark, os.path.join(scratch, "shared"), queries, shared_scan=True)
    assert len(taken) == 1 and len(shared) == len(apart) == 3
    for a, b in zip(apart, shared):
        rows = [sorted(map(tuple, read_report(spark, p, "a string, b string, c string").collect()), key=str) for p in (a, b)]
        assert rows[0] == rows[1] and rows[0]


def test_queries_apart_from_each_other_are_not_shared(spark, scratch):
    points, rects, *_ = files(spark, scratch)
    good = [("hotzoneanalysis", [points, rects]), ("hotcellanalysis", [points])]
    assert jobs._share(good, 0) and not jobs._share(good, 1)
    assert not jobs._share([good[0], good[0]], 0)
    assert not jobs._share([good[0], ("hotcellanalysis", [rects])], 0)
    assert not jobs._share([good[0], ("nosuch", [points])], 0)
    with pytest.raises(KeyError):
        jobs.run_batch(spark, os.path.join(scratch, "bad"), [good[0], ("nosuch", [points])], shared_scan=True)
    assert os.path.isdir(os.path.join(scratch, "bad0"))  # what came before stays


def test_the_command_line_asks_for_a_shared_scan():
    assert parse_args(["--output", "o", "--shared-scan", "--query", "hotcellanalysis", "p"]).shared_scan
