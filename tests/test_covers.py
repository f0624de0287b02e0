import math
import random

import pytest
from pyspark.sql import functions as F

from spacetime.operators import covers as C
from spacetime.operators.zones import COVER, ZoneStats, hot_zones
from spacetime.plans.catalog import QUERIES

INF = math.inf
D = "/root/testdata/sf0.001"


def zones_df(spark, zones):
    return spark.createDataFrame([(f"z{i % 40}", *map(float, z)) for i, z in enumerate(zones)], "rectangle string, x1 double, y1 double, x2 double, y2 double")


def points_df(spark, points, parts=8):
    return spark.createDataFrame([tuple(map(float, p)) for p in points], "px double, py double").repartition(parts)


def brute(points, zones):
    out = {}
    for i, (x1, y1, x2, y2) in enumerate(zones):
        n = sum(x1 <= x <= x2 and y1 <= y <= y2 for x, y in points)
        if n:
            out[f"z{i % 40}"] = out.get(f"z{i % 40}", 0) + n
    return sorted(out.items())


def case(seed, n_points=1500, n_zones=90):
    r = random.Random(seed)
    grid = [r.uniform(-50, 50) for _ in range(12)]
    at = lambda: r.choice([r.choice(grid), r.uniform(-60, 60), r.gauss(0, 3)])
    points = [(at(), at()) for _ in range(n_points)] + [(INF, 0.0), (-INF, INF), (-0.0, 0.0), (math.nan, 1.0), (1e300, -1e300)]
    points += [(grid[0], grid[1])] * 50
    zones = []
    for _ in range(n_zones):
        x, y, size = at(), at(), 10 ** r.uniform(-6, 2)
        z = [x, y, x + size * r.random(), y + size * r.random()]
        for k in range(4):
            if r.random() < 0.1:
                z[k] = -INF if k < 2 else INF
        if r.random() < 0.1:
            z[2], z[3] = z[0], z[1]
        zones.append(z)
    zones += [[-INF, -INF, INF, INF], [grid[0], grid[1], grid[0], grid[1]], [5, 5, 1, 1], [math.nan, 0, 1, 1], [-0.0, 0.0, 0.0, -0.0]]
    return points, zones


@pytest.mark.parametrize("seed,opts", [(1, {}), (2, {"shuffle": True}), (3, {"max_level": 0}), (4, {"max_level": 5, "shuffle": True, "slots_per_partition": 3}), (5, {"spare_cells": 0, "cells_per_zone": 2}), (6, {"max_level": 20, "spare_cells": 200_000})])
def test_counts_match_brute_force(spark, seed, opts):
    points, zones = case(seed)
    got = hot_zones(points_df(spark, points), zones_df(spark, zones), strategy=COVER, **opts).collect()
    assert [(r.rectangle, r.value) for r in got] == brute(points, zones)


def test_auto_takes_the_cover_for_many_zones(spark):
    points, zones = case(7)
    df = hot_zones(points_df(spark, points), zones_df(spark, zones))
    assert "_cell" in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.rectangle, r.value) for r in df.collect()] == brute(points, zones)


def test_no_zones_no_points_and_null_text(spark):
    points, zones = case(8, 50)
    assert hot_zones(points_df(spark, points), zones_df(spark, []), strategy=COVER).collect() == []
    assert hot_zones(points_df(spark, []), zones_df(spark, zones), strategy=COVER, shuffle=True).collect() == []
    nameless = spark.createDataFrame([(None, 0.0, 0.0, 1.0, 1.0)], "rectangle string, x1 double, y1 double, x2 double, y2 double")
    want = [tuple(r) for r in hot_zones(points_df(spark, [(0.5, 0.5)]), nameless).collect()]
    assert [tuple(r) for r in hot_zones(points_df(spark, [(0.5, 0.5)]), nameless, strategy=COVER).collect()] == want == [(None, 0)]


def spans_of(spark, zones):
    df = zones_df(spark, zones).withColumn("id", F.monotonically_increasing_id())
    axes = ZoneStats(df).axes
    frame = C.Frame(tuple(a.low for a in axes), tuple(a.high for a in axes))
    return C.zone_spans(df, frame)


def test_inside_and_border_cells_tile_what_a_zone_touches(spark):
    level = 6
    zones = [[0, 0, 64, 64], [3.2, 5.1, 40.9, 21.3], [-INF, 2, 30, INF], [7, 7, 7, 7], [-INF, -INF, INF, INF], [10.5, 20.5, 11.5, 60]]
    spans = spans_of(spark, zones)
    border = {(r.rectangle, r._cell) for r in C.border_of(spans, level, ["rectangle"]).collect()}
    inside = {}
    for r in C.inside_of(spans, level, ["rectangle"]).collect():
        depth = (r._name.bit_length() - 1) // 2
        key = r._name - (1 << 2 * depth)
        for c in range(key << 2 * (level - depth), (key + 1) << 2 * (level - depth)):
            assert (r.rectangle, c) not in inside, "a cell is held twice"
            inside[r.rectangle, c] = depth
    assert not border & set(inside)
    assert any(depth < level for depth in inside.values())
    wanted = spans.select("rectangle", *[c.alias(n) for i in (0, 1) for c, n in zip((*C.touched(i, level), *C.between(i, level)), (f"a{i}", f"b{i}", f"i{i}", f"j{i}"))]).collect()
    sizes = {}
    for w in wanted:
        full = (w.b0 - w.a0 + 1) * (w.b1 - w.a1 + 1)
        inner = max(0, w.j0 - w.i0 + 1) * max(0, w.j1 - w.i1 + 1)
        sizes[w.rectangle] = (full - inner, inner)
    for name, (n_border, n_inside) in sizes.items():
        assert sum(b[0] == name for b in border) == n_border
        assert sum(i[0] == name for i in inside) == n_inside
    assert sizes["z4"] == (0, 4**level)  # no edge, no border


def test_a_key_a_point_and_counts_before_the_inside_join(spark):
    """Between the point scan and the first join or aggregate nothing makes
    rows, and the inside cells join aggregated counts."""
    df = QUERIES["hot_zones_unbounded"](spark, D)
    plan = df._jdf.queryExecution().optimizedPlan()

    def walk(node, above):
        name = node.nodeName()
        kids = node.children()
        below = [walk(kids.apply(i), [*above, name]) for i in range(kids.size())]
        if not kids.size():
            return [(node.toString(), [*above, name])]
        return [x for b in below for x in b]

    paths = [above for text, above in walk(plan, []) if "l_quantity" in text or "l_extendedprice" in text]
    assert len(paths) == 2
    for above in paths:
        tail = above[::-1]
        stop = next(i for i, n in enumerate(tail) if n in ("Join", "Aggregate"))
        assert "Generate" not in tail[:stop] and "Expand" not in tail[:stop]
    kinds = sorted(next(n for n in above[::-1] if n in ("Join", "Aggregate")) for above in paths)
    assert kinds == ["Aggregate", "Join"]


def test_shuffled_points_are_scanned_once(spark):
    df = QUERIES["hot_zones_cover_shuffle"](spark, D)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("l_quantity") and "ReusedExchange" in final
    assert sum("FileScan" in line and "l_quantity" in line for line in final.splitlines()) == 1


@pytest.mark.parametrize("kind", ["uniform", "third in one tile", "third at one place", "all in one cell"])
def test_no_partition_above_twice_the_mean(spark, kind):
    r = random.Random(9)
    n = 24_000
    if kind == "uniform":
        points = [(r.uniform(0, 100), r.uniform(0, 100)) for _ in range(n)]
    elif kind == "third in one tile":
        points = [(r.uniform(50, 50.01), r.uniform(50, 50.01)) if i % 3 == 0 else (r.uniform(0, 100), r.uniform(0, 100)) for i in range(n)]
    elif kind == "third at one place":
        points = [(50.0, 50.0) if i % 3 == 0 else (r.uniform(0, 100), r.uniform(0, 100)) for i in range(n)]
    else:
        points = [(r.uniform(1, 1.001), r.uniform(1, 1.001)) for _ in range(n)]
    partitions, level = 8, 5
    pts = points_df(spark, points, 64)
    frame = C.Frame((0.0, 0.0), (100.0, 100.0))
    keyed = C.point_keys(pts, frame, "px", "py")
    slots = C.slots_of(keyed, 32 * partitions, 200_000)
    dealt = C.dealt_points(keyed, slots, level, partitions, "px", "py")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == n
    assert max(sizes) <= 2 * n / partitions


def test_slots_find_as_they_place(spark):
    slots = C.Slots([5.0, 5.0, 9.0, 20.0])
    keys = [0, 4, 5, 6, 8, 9, 19, 20, 10**15]
    rows = slots.find(spark.createDataFrame([(k,) for k in keys], "k long"), "k", "s").collect()
    assert [r.s for r in rows] == [slots.place(k) for k in keys]
    assert slots.parts[slots.place(5)] == 2 and slots.parts[slots.place(6)] == 1
