"""Property-based checks (hypothesis) against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spacetime.functions.grid import GridSpec
from spacetime.operators.zones import TILED_BROADCAST, TILED_SHUFFLE, zone_point_pairs

from test_gistar import brute_gi, scores
from test_zones import brute_pairs

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

coord = st.floats(min_value=-100, max_value=100, allow_nan=False).map(lambda v: round(v, 3))
size = st.sampled_from([0.0, 0.5, 2.0, 7.5, 30.0, 250.0])


@st.composite
def zone(draw):
    x, y = draw(coord), draw(coord)
    return (x, y, x + draw(size) * draw(st.sampled_from([1, -1, 0.3])), y + draw(size))


@SETTINGS
@given(
    pts=st.lists(st.tuples(coord, coord), min_size=1, max_size=60),
    zones=st.lists(zone(), min_size=1, max_size=25),
    tile=st.sampled_from([None, 0.25, 3.0, 40.0]),
    fanout=st.sampled_from([2, 4, 8]),
    axis_tiles=st.sampled_from([1, 2, 4]),
    shuffle=st.booleans(),
)
def test_tiled_join_is_exact(spark, pts, zones, tile, fanout, axis_tiles, shuffle):
    edge_pts = pts + [(z[0], z[1]) for z in zones] + [(z[2], z[3]) for z in zones]  # corners sit on edges
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(edge_pts)], "pid long, px double, py double")
    z = spark.createDataFrame([(i,) + tuple(map(float, r)) for i, r in enumerate(zones)],
                              "zid long, x1 double, y1 double, x2 double, y2 double")
    opts = dict(strategy=TILED_SHUFFLE if shuffle else TILED_BROADCAST, tile=tile, fanout=fanout,
                axis_tiles=axis_tiles, salt=3)
    got = sorted((r.zid, r.pid) for r in zone_point_pairs(p, z, **opts).select("zid", "pid").collect())
    assert got == brute_pairs(edge_pts, zones)


@SETTINGS
@given(
    dims=st.tuples(st.integers(1, 5), st.integers(1, 5), st.integers(1, 4)),
    cells=st.lists(st.tuples(st.integers(-2, 7), st.integers(-2, 7), st.integers(-1, 6), st.integers(1, 9)),
                   min_size=1, max_size=40, unique_by=lambda c: c[:3]),
)
def test_gi_star_matches_brute_force(spark, dims, cells):
    w, h, d = dims
    g = GridSpec(0, w - 1, 0, h - 1, 1, d, step_x=1.0, step_y=1.0)
    got = scores(spark, cells, g)
    want = brute_gi({c[:3]: c[3] for c in cells}, g)
    assert set(got) == set(want)
    for k, v in want.items():
        if v is None:
            assert got[k] is None
        else:
            assert got[k] is not None and abs(got[k] - v) <= 1e-9 * max(1.0, abs(v))


finite = st.floats(allow_nan=False, allow_infinity=False)


@SETTINGS
@given(pts=st.lists(st.tuples(finite, finite), min_size=1, max_size=30),
       rects=st.lists(st.tuples(finite, finite, finite, finite), min_size=1, max_size=10))
def test_text_round_trip_is_exact(spark, pts, rects):
    from spacetime.operators.zones import points_from_text, zones_from_text

    pdf = spark.createDataFrame([(i, f"({x!r},{y!r})") for i, (x, y) in enumerate(pts)], "i long, point string")
    got = [(r.px, r.py) for r in points_from_text(pdf, "point", keep=["i"]).orderBy("i").collect()]
    assert got == pts
    rdf = spark.createDataFrame([(i, ",".join(repr(v) for v in r)) for i, r in enumerate(rects)], "i long, rectangle string")
    zs = zones_from_text(rdf, "rectangle").collect()
    assert sorted((z.x1, z.y1, z.x2, z.y2) for z in zs) == sorted(rects)
