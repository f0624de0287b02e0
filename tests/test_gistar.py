import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from spacetime.functions.grid import GridSpec
from spacetime.operators.cells import assign_cells, cell_counts, grid_totals
from spacetime.operators.gistar import hot_cells, score_cells, top_cells
from spacetime.operators.neighbors import adjacent_cell_pairs, neighbor_sums

G4 = GridSpec(1, 4, 1, 4, 1, 4, step_x=1.0, step_y=1.0)  # n = 64


def counts_df(spark, rows):
    return spark.createDataFrame(rows, "x long, y long, z int, n long")


def scores(spark, rows, spec):
    return {(r.x, r.y, r.z): r.zscore for r in score_cells(counts_df(spark, rows), spec).collect()}


def brute_gi(counts: dict, spec: GridSpec):
    n = float(spec.num_cells)
    total = sum(counts.values())
    mean = total / n
    var = sum(v * v for v in counts.values()) / n - mean * mean
    s = math.sqrt(var) if var >= 0 else None
    out = {}
    for (x, y, z), _ in counts.items():
        if not (spec.min_x <= x <= spec.max_x and spec.min_y <= y <= spec.max_y and spec.min_z <= z <= spec.max_z):
            continue
        sum1 = 0
        w = 0
        for dx, dy, dz in itertools.product((-1, 0, 1), repeat=3):
            c = (x + dx, y + dy, z + dz)
            if spec.min_x <= c[0] <= spec.max_x and spec.min_y <= c[1] <= spec.max_y and spec.min_z <= c[2] <= spec.max_z:
                w += 1
                sum1 += counts.get(c, 0)
        den = None if s is None or n == 1 else s * math.sqrt((n * w - w * w) / (n - 1))
        out[(x, y, z)] = None if not den else (sum1 - mean * w) / den
    return out


@pytest.mark.parametrize("c", [1, 7])
def test_golden_corner(spark, c):
    got = scores(spark, [(1, 1, 1, c)], G4)
    assert list(got) == [(1, 1, 1)]
    assert got[(1, 1, 1)] == pytest.approx(math.sqrt(7), rel=1e-12)


@pytest.mark.parametrize("c", [1, 3])
def test_golden_interior(spark, c):
    got = scores(spark, [(2, 2, 2, c)], G4)
    assert got[(2, 2, 2)] == pytest.approx(37 / math.sqrt(999), rel=1e-12)


def test_golden_empty(spark):
    assert scores(spark, [], G4) == {}


def test_whole_grid_neighbourhood_is_null(spark):
    """3x3x3 grid: the centre covers everything -> zero denominator -> NULL."""
    g3 = GridSpec(1, 3, 1, 3, 1, 3, step_x=1.0, step_y=1.0)
    got = scores(spark, [(2, 2, 2, 4), (1, 1, 1, 1)], g3)
    assert got[(2, 2, 2)] is None
    assert got[(1, 1, 1)] is not None


def test_neighbour_sum_counts_each_neighbour_once(spark):
    """(1,3,3) is the (-1,+1,+1) neighbour of (2,2,2): counted exactly once."""
    df = counts_df(spark, [(2, 2, 2, 1), (1, 3, 3, 5)])
    got = {(r.x, r.y, r.z): (r.sum1, r.w, r.n) for r in neighbor_sums(df, G4).collect()}
    assert got[(2, 2, 2)] == (6, 27, 1)
    assert got[(1, 3, 3)] == (6, 18, 5)  # on the x = 1 face: 2 * 3 * 3 slots
    assert len(got) == 2


def test_off_grid_points_count_in_totals(spark):
    df = counts_df(spark, [(2, 2, 2, 3), (9, 9, 9, 4)])
    t = grid_totals(df, G4).first()
    assert (t.n_points, t.n_cells, t.sum_sq) == (7, 2, 25)
    assert t.mean == 7 / 64
    got = scores(spark, [(2, 2, 2, 3), (9, 9, 9, 4)], G4)
    assert list(got) == [(2, 2, 2)]  # off-grid cells are never scored


def test_clip_drops_off_grid_first(spark):
    pts = spark.createDataFrame([(1.5, 1.5, "2024-01-02 00:00:00"), (9.5, 9.5, "2024-01-02 00:00:00")],
                                "px double, py double, t string").withColumn("t", F.to_timestamp_ntz("t"))
    cells = assign_cells(pts, G4)
    assert cell_counts(cells, G4, clip=True).count() == 1
    assert cell_counts(cells, G4).count() == 2


def test_last_cell_of_default_grid_is_scored(spark):
    g = GridSpec.default()
    got = scores(spark, [(-7370, 4050, 31, 3), (-7450, 4090, 31, 2), (-7450, 4090, 3, 1)], g)
    assert set(got) == {(-7370, 4050, 31), (-7450, 4090, 31), (-7450, 4090, 3)}


def test_only_populated_cells_returned(spark):
    rows = [(1, 1, 1, 2), (4, 4, 4, 1)]
    out = hot_cells_from_counts(spark, rows, G4, k=50)
    assert len(out) == 2


def hot_cells_from_counts(spark, rows, spec, k):
    return top_cells(score_cells(counts_df(spark, rows), spec), k, with_score=True).collect()


def test_top_k_ties_broken_by_coordinates(spark):
    # all four corners of the bottom layer hold the same count -> same score
    rows = [(1, 1, 1, 5), (4, 1, 1, 5), (1, 4, 1, 5), (4, 4, 1, 5), (2, 2, 3, 1)]
    out = hot_cells_from_counts(spark, rows, G4, k=3)
    assert [(r.x, r.y, r.z) for r in out] == [(1.0, 1.0, 1.0), (1.0, 4.0, 1.0), (4.0, 1.0, 1.0)]
    assert all(isinstance(r.x, float) for r in out)


def test_matches_brute_force_random(spark):
    rnd = random.Random(7)
    g = GridSpec(-3, 4, 0, 5, 1, 6, step_x=1.0, step_y=1.0)
    counts = {}
    for _ in range(120):
        c = (rnd.randint(-5, 6), rnd.randint(-1, 7), rnd.randint(0, 7))
        counts[c] = counts.get(c, 0) + rnd.randint(1, 9)
    got = scores(spark, [(a, b, c, v) for (a, b, c), v in counts.items()], g)
    want = brute_gi(counts, g)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12)


def test_hot_cells_end_to_end(spark):
    pts = spark.createDataFrame(
        [(2.5, 2.5, "2024-01-02 10:00:00")] * 5 + [(3.5, 2.5, "2024-01-02 11:00:00")] + [(1.2, 4.9, "2024-01-04 00:00:00")],
        "px double, py double, t string",
    ).withColumn("t", F.to_timestamp_ntz("t"))
    out = hot_cells(pts, G4, k=2, with_score=True).collect()
    cnt = {(2, 2, 2): 5, (3, 2, 2): 1, (1, 4, 4): 1}
    want = sorted(brute_gi(cnt, G4).items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert [(r.x, r.y, r.z) for r in out] == [tuple(float(v) for v in k) for k, _ in want]


def test_adjacent_pairs_match_brute_force(spark):
    rnd = random.Random(3)
    cells = {(rnd.randint(1, 4), rnd.randint(1, 4), rnd.randint(1, 4)) for _ in range(30)}
    df = spark.createDataFrame(list(cells), "x long, y long, z int")
    got = {tuple(r) for r in adjacent_cell_pairs(df, G4).collect()}
    want = {a + b for a in cells for b in cells if all(abs(i - j) <= 1 for i, j in zip(a, b))}
    assert got == want


def test_far_off_grid_cells_emit_nothing(spark):
    from spacetime.operators.neighbors import _scatter

    df = counts_df(spark, [(100, 100, 2, 5), (5, 2, 2, 3)])  # far away; on the ring x = max + 1
    rows = _scatter(df, G4).collect()
    assert len(rows) == 9  # the ring cell reaches 3 x 3 in-grid cells ...
    assert all(r.n is None for r in rows)  # ... but contributes nothing


def test_months_and_years_fold_into_day_of_month(spark):
    pts = spark.createDataFrame(
        [(1.5, 1.5, "2009-01-03 08:00:00"), (1.5, 1.5, "2011-06-03 23:59:59"), (1.5, 1.5, "2012-02-03 00:00:00")],
        "px double, py double, t string",
    ).withColumn("t", F.to_timestamp_ntz("t"))
    rows = cell_counts(assign_cells(pts, G4), G4).collect()
    assert [(r.x, r.y, r.z, r.n) for r in rows] == [(1, 1, 3, 3)]


def test_null_scores_sort_last(spark):
    g3 = GridSpec(1, 3, 1, 3, 1, 3, step_x=1.0, step_y=1.0)
    out = hot_cells_from_counts(spark, [(2, 2, 2, 4), (1, 1, 1, 1), (3, 3, 3, 2)], g3, k=3)
    assert (out[-1].x, out[-1].y, out[-1].z) == (2.0, 2.0, 2.0) and out[-1].zscore is None
    assert all(r.zscore is not None for r in out[:-1])


def test_inconsistent_moments_give_null_not_nan(spark):
    """Many off-grid points can make the grid variance negative: NULL scores."""
    g1 = GridSpec(0, 0, 0, 0, 1, 1, step_x=1.0, step_y=1.0)
    got = scores(spark, [(0, 0, 1, 1), (0, 0, 5, 9)], g1)
    assert got == {(0, 0, 1): None}


def test_one_cell_grid_gives_null_not_error(spark):
    g1 = GridSpec(0, 0, 0, 0, 1, 1, step_x=1.0, step_y=1.0)
    assert scores(spark, [(0, 0, 1, 3)], g1) == {(0, 0, 1): None}


@pytest.mark.parametrize("block", [None, 1, 2, 16])
def test_block_colocation_does_not_change_sums(spark, block):
    rnd = random.Random(11)
    g = GridSpec(-3, 9, 0, 7, 1, 6, step_x=1.0, step_y=1.0)
    counts = {}
    for _ in range(150):
        c = (rnd.randint(-5, 11), rnd.randint(-2, 9), rnd.randint(0, 7))
        counts[c] = counts.get(c, 0) + rnd.randint(1, 5)
    df = counts_df(spark, [(a, b, c, v) for (a, b, c), v in counts.items()])
    got = sorted(tuple(r) for r in neighbor_sums(df, g, block=block).collect())
    want = sorted(tuple(r) for r in neighbor_sums(df, g, block=None).collect())
    assert got == want and len(got) > 0


def test_hot_cell_holding_a_third_of_all_points(spark):
    """A skewed cell is combined map-side and scored exactly."""
    import contextlib
    import io

    rnd = random.Random(21)
    hot = [(2.5, 2.5, "2024-01-02 10:00:00")] * 3000
    rest = [(rnd.uniform(1, 5), rnd.uniform(1, 5), f"2024-01-0{rnd.randint(1, 4)} 12:00:00") for _ in range(6000)]
    pts = spark.createDataFrame(hot + rest, "px double, py double, t string").withColumn("t", F.to_timestamp_ntz("t"))
    df = hot_cells(pts.repartition(6), G4, k=64, with_score=True)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    assert "partial_count" in buf.getvalue()
    got = {(r.x, r.y, r.z): r.zscore for r in df.collect()}
    cnt = {}
    for x, y, t in hot + rest:
        c = (int(x // 1), int(y // 1), int(t[8:10]))
        cnt[c] = cnt.get(c, 0) + 1
    want = brute_gi(cnt, G4)
    assert set(got) == {tuple(float(v) for v in k) for k in want}
    for k, v in want.items():
        assert got[tuple(float(c) for c in k)] == pytest.approx(v, rel=1e-9)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_moments_do_not_overflow(spark, ansi):
    import math

    from pyspark.sql import functions as F

    from spacetime.functions.grid import GridSpec
    from spacetime.operators.cells import grid_totals
    from spacetime.operators.gistar import score_cells

    spec = GridSpec.default()
    one = spark.createDataFrame([(spec.min_x + 3, spec.min_y + 3, 5, 4_000_000_000), (spec.min_x + 9, spec.min_y + 9, 9, 1)], "x long, y long, z int, n long")
    xs = spark.range(spec.min_x, spec.max_x + 1).toDF("x")
    full = xs.crossJoin(spark.range(spec.min_y, spec.max_y + 1).toDF("y")).crossJoin(spark.range(spec.min_z, spec.max_z + 1).select(F.col("id").cast("int").alias("z"))).withColumn("n", F.lit(10_000_000) + F.col("x") % 2)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert grid_totals(one, spec).first().sum_sq == float(4_000_000_000**2 + 1)
        assert grid_totals(full, spec).first().sum_sq > 1e19
        for counts in (one, full):
            assert all(r.zscore is not None and math.isfinite(r.zscore) for r in score_cells(counts, spec).collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_nan_lies_in_no_cell_on_both_paths(spark):
    from spacetime.functions.grid import GridSpec
    from spacetime.operators.cells import assign_cells, cell_counts
    from spacetime.operators.gistar import hot_cells

    spec = GridSpec(0, 4, 0, 4, 1, 31, step_x=1.0, step_y=1.0)
    pts = spark.sql("SELECT double(px) px, double(py) py, timestamp_ntz'2009-01-05 00:00:00' t FROM VALUES ('0.5', '1.5'), ('NaN', '1.5'), ('0.5', 'NaN'), (NULL, '1.0') v(px, py)")
    for clip in (False, True):
        assert [r.n for r in cell_counts(assign_cells(pts, spec), spec, clip=clip).collect()] == [1]
        assert len(hot_cells(pts, spec, clip=clip).collect()) == 1
    from spacetime.functions.sql import register_sql_functions

    register_sql_functions(spark)
    assert tuple(spark.range(1).selectExpr("CalculateX('(NaN,1)') AS x", "CalculateY('(1,NaN)') AS y").first()) == (None, None)
