import random

import pytest
from pyspark.sql import functions as F

from spacetime.operators.zones import (
    NESTED_LOOP,
    TILED_BROADCAST,
    TILED_SHUFFLE,
    hot_zones,
    plan_tiles,
    points_from_text,
    zone_point_pairs,
    zone_tiles,
    zones_from_text,
)

POINTS = ["(0,0)", "(10,10)", "(5,5)", "(7,7)", "(12,12)", "(10.0001,3)"]
RECTS = ["0,0,10,10", "5,5,15,15", "100,100,101,101", "10,10,0,0", "0,0,10,10"]
ALL = [dict(strategy=NESTED_LOOP), dict(strategy=TILED_BROADCAST), dict(strategy=TILED_SHUFFLE, salt=3),
       dict(strategy=TILED_BROADCAST, tile=0.7), dict(strategy=TILED_SHUFFLE, tile=100.0, salt=1),
       dict(strategy=TILED_BROADCAST, tile=0.01, axis_tiles=2, fanout=2)]


def pts_df(spark, texts):
    return points_from_text(spark.createDataFrame([(t,) for t in texts], "point string"), "point")


def zones_df(spark, texts):
    return zones_from_text(spark.createDataFrame([(t,) for t in texts], "rectangle string"), "rectangle")


@pytest.mark.parametrize("opts", ALL, ids=lambda o: "-".join(f"{k}={v}" for k, v in o.items()))
def test_golden_hot_zones(spark, opts):
    out = hot_zones(pts_df(spark, POINTS), zones_df(spark, RECTS), **opts).collect()
    # duplicate rectangle rows add up; empty and reversed zones are absent
    assert [(r.rectangle, r.value) for r in out] == [("0,0,10,10", 8), ("5,5,15,15", 4)]


def test_output_schema(spark):
    out = hot_zones(pts_df(spark, POINTS), zones_df(spark, RECTS))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [("rectangle", "string"), ("value", "bigint")]


def test_text_keys_are_not_normalised(spark):
    out = hot_zones(pts_df(spark, ["(1,1)"]), zones_df(spark, ["1.0,0,2,2", "1,0,2,2"])).collect()
    assert [(r.rectangle, r.value) for r in out] == [("1,0,2,2", 1), ("1.0,0,2,2", 1)]


def brute_pairs(points, zones):
    return sorted(
        (zi, pi)
        for zi, (x1, y1, x2, y2) in enumerate(zones)
        for pi, (px, py) in enumerate(points)
        if x1 <= px <= x2 and y1 <= py <= y2
    )


def random_case(seed, n_pts=400, n_zones=60):
    rnd = random.Random(seed)
    pts = [(round(rnd.uniform(-50, 50), 2), round(rnd.uniform(-50, 50), 2)) for _ in range(n_pts)]
    pts += [(float(rnd.randint(-50, 50)), float(rnd.randint(-50, 50))) for _ in range(100)]  # on edges
    zones = []
    for _ in range(n_zones):
        x, y = rnd.randint(-55, 50), rnd.randint(-55, 50)
        size = rnd.choice([0, 0.5, 1, 3, 10, 40, 120])  # very mixed sizes, one zone may cover all
        w, h = size * rnd.random(), size * rnd.random()
        zones.append((float(x), float(y), x + w, y + h))
    zones.append((-1000.0, -1000.0, 1000.0, 1000.0))
    zones.append((5.0, 5.0, 1.0, 9.0))  # reversed
    return pts, zones


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("opts", ALL[1:], ids=lambda o: "-".join(f"{k}={v}" for k, v in o.items()))
def test_tiled_equals_brute_force(spark, seed, opts):
    pts, zones = random_case(seed)
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid long, px double, py double")
    z = spark.createDataFrame([(i,) + r for i, r in enumerate(zones)], "zid long, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.zid, r.pid) for r in zone_point_pairs(p, z, **opts).select("zid", "pid").collect())
    assert got == brute_pairs(pts, zones)


def test_mixed_sizes_use_several_levels_without_caps(spark):
    _, zones = random_case(5)
    z = spark.createDataFrame(zones, "x1 double, y1 double, x2 double, y2 double")
    plan = plan_tiles(z, tile=1.0, fanout=4, axis_tiles=4)
    assert len(plan.levels) >= 3
    per_zone = zone_tiles(z, plan).groupBy("x1", "y1", "x2", "y2").count().agg(F.max("count")).first()[0]
    # no zone explodes beyond ~ (fanout * axis_tiles + 1)^2 tiles, and none is dropped
    assert per_zone <= (4 * 4 + 1) ** 2
    assert zone_tiles(z, plan).select("x1", "y1", "x2", "y2").distinct().count() == len(zones) - 1
    # the planned tile count is exact (it is the broadcast size bound)
    assert plan.n_tiles == zone_tiles(z, plan).count()


def test_counts_invariant_under_repartitioning(spark):
    pts, zones = random_case(9)
    p = spark.createDataFrame(pts, "px double, py double")
    z = spark.createDataFrame([(f"z{i}",) + r for i, r in enumerate(zones)], "rectangle string, x1 double, y1 double, x2 double, y2 double")
    a = {tuple(r) for r in hot_zones(p, z, strategy=TILED_SHUFFLE).collect()}
    b = {tuple(r) for r in hot_zones(p.repartition(7), z, strategy=TILED_SHUFFLE).collect()}
    c = {tuple(r) for r in hot_zones(p.coalesce(1), z, strategy=TILED_BROADCAST).collect()}
    assert a == b == c


def test_nested_loop_refuses_large_zone_sets(spark):
    z = spark.range(100).select(F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.lit(1.0).alias("x2"), F.lit(1.0).alias("y2"))
    p = spark.createDataFrame([(0.5, 0.5)], "px double, py double")
    with pytest.raises(ValueError):
        zone_point_pairs(p, z, strategy=NESTED_LOOP, nested_loop_max_zones=10)
    # auto falls through to the tiled join and stays exact
    assert zone_point_pairs(p, z, nested_loop_max_zones=10).count() == 100


def test_tiled_broadcast_refuses_too_many_tiles(spark):
    z = spark.createDataFrame([(0.0, 0.0, 100.0, 100.0)], "x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(0.5, 0.5)], "px double, py double")
    with pytest.raises(ValueError):
        zone_point_pairs(p, z, strategy=TILED_BROADCAST, tile=1.0, axis_tiles=1000, broadcast_max_bytes=100)
    # the auto path goes to the shuffle join instead
    assert zone_point_pairs(p, z, tile=1.0, axis_tiles=1000, broadcast_max_bytes=100, nested_loop_max_zones=0).count() == 1


def test_permissive_text_drops_bad_rows(spark):
    p = points_from_text(spark.createDataFrame([("(1,1)",), ("(abc,2)",), ("(3)",), (None,)], "point string"),
                         "point", mode="permissive")
    assert p.count() == 1
    z = zones_from_text(spark.createDataFrame([("0,0,2,2",), ("0,x,1,1",)], "rectangle string"), "rectangle",
                        mode="permissive")
    assert [tuple(r) for r in hot_zones(p, z).collect()] == [("0,0,2,2", 1)]


def test_strict_text_fails_fast(spark):
    p = points_from_text(spark.createDataFrame([("(abc,2)",)], "point string"), "point")
    with pytest.raises(Exception):
        p.collect()


def test_hot_tile_is_spread_by_salt(spark):
    """A third of the points in one tile: the salt spreads them evenly."""
    from spacetime.operators.zones import plan_tiles, point_tiles

    rnd = random.Random(4)
    hot = [(0.5 + rnd.random() * 1e-3, 0.5 + rnd.random() * 1e-3) for _ in range(3000)]
    rest = [(rnd.uniform(0, 100), rnd.uniform(0, 100)) for _ in range(6000)]
    p = spark.createDataFrame(hot + rest, "px double, py double")
    z = spark.createDataFrame([(f"z{i}", float(i), float(i), i + 1.0, i + 1.0) for i in range(100)],
                              "rectangle string, x1 double, y1 double, x2 double, y2 double")
    pairs = zone_point_pairs(p, z, strategy=TILED_SHUFFLE, tile=1.0, salt=8)
    assert pairs.count() == len(brute_pairs(hot + rest, [(i, i, i + 1.0, i + 1.0) for i in range(100)]))
    plan = plan_tiles(z, tile=1.0)
    salted = point_tiles(p, plan).filter("tx = 0 AND ty = 0").select(
        F.pmod(F.xxhash64("px", "py", F.monotonically_increasing_id()), F.lit(8)).alias("s"))
    sizes = [r["count"] for r in salted.groupBy("s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * (sum(sizes) / 8)


def test_level_count_is_bounded_and_exact(spark):
    """Zone sizes over 9 orders of magnitude: few levels, same pairs."""
    from spacetime.operators.zones import plan_tiles

    rnd = random.Random(8)
    zones = [(float(x), float(x), x + 10.0 ** e, x + 10.0 ** e) for e in range(-4, 5) for x in range(0, 40, 7)]
    pts = [(rnd.uniform(-1, 60), rnd.uniform(-1, 60)) for _ in range(300)] + [(z[0], z[1]) for z in zones]
    z = spark.createDataFrame([(i,) + r for i, r in enumerate(zones)], "zid long, x1 double, y1 double, x2 double, y2 double")
    plan = plan_tiles(z, tile=1e-4, fanout=2, axis_tiles=2, max_levels=4)
    assert len(plan.levels) <= 4 and min(plan.fanouts) > 2
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid long, px double, py double")
    got = sorted((r.zid, r.pid) for r in zone_point_pairs(p, z, strategy=TILED_BROADCAST, tile=1e-4, fanout=2,
                                                          axis_tiles=2).select("zid", "pid").collect())
    assert got == brute_pairs(pts, zones)


@pytest.mark.parametrize("strategy", [NESTED_LOOP, TILED_BROADCAST, TILED_SHUFFLE])
def test_no_valid_zones_gives_empty_result(spark, strategy):
    p = pts_df(spark, POINTS)
    assert hot_zones(p, zones_df(spark, ["10,10,0,0", "5,9,1,9"]), strategy=strategy).collect() == []
    empty = spark.createDataFrame([], "rectangle string, x1 double, y1 double, x2 double, y2 double")
    assert hot_zones(p, empty, strategy=strategy).collect() == []


@pytest.mark.parametrize("opts", [dict(), dict(strategy=TILED_BROADCAST), dict(strategy=TILED_SHUFFLE, salt=8)],
                         ids=["auto", "tiled_broadcast", "tiled_shuffle"])
def test_one_coordinate_with_a_third_of_all_points(spark, opts):
    rnd = random.Random(12)
    pts = [(3.0, 3.0)] * 2000 + [(rnd.uniform(0, 20), rnd.uniform(0, 20)) for _ in range(4000)]
    zones = [(f"z{i}", float(i), float(i), i + 4.0, i + 4.0) for i in range(0, 20, 2)]
    p = spark.createDataFrame(pts, "px double, py double").repartition(5)
    z = spark.createDataFrame(zones, "rectangle string, x1 double, y1 double, x2 double, y2 double")
    got = {r.rectangle: r.value for r in hot_zones(p, z, tile=1.0, **opts).collect()}
    want = {}
    for name, x1, y1, x2, y2 in zones:
        n = sum(1 for px, py in pts if x1 <= px <= x2 and y1 <= py <= y2)
        if n:
            want[name] = n
    assert got == want


INF = float("inf")


@pytest.mark.parametrize("copies", [1, 20])
@pytest.mark.parametrize("opts", [dict(), dict(strategy=TILED_BROADCAST), dict(strategy=TILED_SHUFFLE, salt=4)], ids=["auto", "broadcast", "shuffle"])
def test_unbounded_zones_join_at_any_zone_count(spark, opts, copies):
    rnd = random.Random(21)
    zones = [(-INF, -INF, INF, INF), (-INF, 2.0, 5.0, INF), (3.0, -INF, 4.0, INF), (-1.7e308, 0.0, 1.7e308, 1.0)]
    zones += [(float(i), float(i), i + 2.0, i + 3.0) for i in range(5)] * copies
    pts = [(rnd.uniform(-3, 9), rnd.uniform(-3, 9)) for _ in range(200)]
    z = spark.createDataFrame([(i,) + r for i, r in enumerate(zones)], "zid long, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid long, px double, py double")
    got = sorted((r.zid, r.pid) for r in zone_point_pairs(p, z, **opts).select("zid", "pid").collect())
    assert got == brute_pairs(pts, zones)


@pytest.mark.parametrize("levels", [0, 1])
def test_too_few_levels_is_an_error(spark, levels):
    z = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0), (0.0, 0.0, 9.0, 9.0)], "x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(0.5, 0.5)], "px double, py double")
    with pytest.raises(ValueError, match="max_levels"):
        zone_point_pairs(p, z, max_levels=levels, nested_loop_max_zones=0)


def test_extreme_size_spans_are_exact(spark):
    zones = [(0.0, 0.0, 1e-20, 1e-20), (0.0, 0.0, 1e19, 1e19), (5.0, 5.0, 5.0, 5.0), (1e18, 1e18, 2e18, 2e18), (-1.0, -1.0, 3.0, 3.0)]
    pts = [(0.0, 0.0), (5e-21, 5e-21), (5.0, 5.0), (1.5e18, 1.5e18), (2.0, 2.0), (-0.5, 1e19)]
    z = spark.createDataFrame([(i,) + r for i, r in enumerate(zones)], "zid long, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid long, px double, py double")
    for opts in (dict(strategy=TILED_BROADCAST), dict(strategy=TILED_SHUFFLE)):
        got = sorted((r.zid, r.pid) for r in zone_point_pairs(p, z, **opts).select("zid", "pid").collect())
        assert got == brute_pairs(pts, zones)


def test_point_like_zones_spread_over_many_tiles(spark):
    z = spark.range(20000).select((F.rand(1) * 0.5 - 74).alias("x1"), (F.rand(2) * 0.4 + 40).alias("y1")).withColumns({"x2": F.col("x1"), "y2": F.col("y1")})
    z = spark.createDataFrame(z.collect(), z.schema)
    tiles = zone_tiles(z, plan_tiles(z)).groupBy("tx", "ty").count()
    assert tiles.count() > 2000 and tiles.agg(F.max("count")).first()[0] < 50


def test_thin_zones_make_few_candidates(spark):
    """Zones of 1 x 200: candidates stay within a small factor of the matches."""
    from spacetime.operators.zones import TILE_KEYS, point_tiles

    rnd = random.Random(31)
    zones = [(x, y, x + 1.0, y + 200.0) for x, y in ((rnd.uniform(0, 50), rnd.uniform(0, 100000)) for _ in range(2000))]
    pts = [(rnd.uniform(0, 50), rnd.uniform(0, 100000)) for _ in range(20000)]
    z = spark.createDataFrame(zones, "x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame(pts, "px double, py double")
    plan = plan_tiles(z)
    candidates = point_tiles(p, plan).join(zone_tiles(z, plan), list(TILE_KEYS)).count()
    assert candidates <= 6 * max(1000, zone_point_pairs(p, z).count())


def test_wide_zones_are_not_broadcast(spark):
    z = spark.range(200).select(F.col("id").alias("zid"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), (F.col("id") + 1.0).alias("x2"), F.lit(5.0).alias("y2"), F.repeat(F.lit("x"), 10_000).alias("payload"))
    p = spark.createDataFrame([(0.5, 0.5), (100.5, 1.0)], "px double, py double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        wide = zone_point_pairs(p, z, broadcast_max_bytes=1 << 20, salt=1)
        narrow = zone_point_pairs(p, z.drop("payload"), broadcast_max_bytes=1 << 20, salt=1)
        assert "Broadcast" not in wide._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in narrow._jdf.queryExecution().executedPlan().toString()
        assert wide.count() == narrow.count() == 300
        assert wide.agg(F.min(F.length("payload"))).first()[0] == 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_tile_with_a_third_of_all_points(spark):
    rnd = random.Random(5)
    zones = [(float(x), float(y), x + 10.0, y + 10.0) for x in range(0, 100, 10) for y in range(0, 100, 10)]
    pts = [(50 + rnd.random(), 50 + rnd.random()) for _ in range(1000)] + [(rnd.uniform(0, 100), rnd.uniform(0, 100)) for _ in range(2000)]
    z = spark.createDataFrame([(i,) + r for i, r in enumerate(zones)], "zid long, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid long, px double, py double")
    got = sorted((r.zid, r.pid) for r in zone_point_pairs(p, z, strategy=TILED_SHUFFLE).select("zid", "pid").collect())
    assert got == brute_pairs(pts, zones)
