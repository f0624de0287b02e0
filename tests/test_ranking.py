import os
import random

import numpy as np
import pytest

from spacetime.functions.grid import GridSpec
from spacetime.operators.gistar import hot_cells
from spacetime.streaming.hotspots import read_latest, stream_location
from spacetime.streaming.ranking import contributions, start_hot_cells_incremental

SPEC = GridSpec(min_x=-20, max_x=25, min_y=-18, max_y=20, min_z=1, max_z=31, step_x=1.0, step_y=1.0)
SCHEMA = "px double, py double, t timestamp_ntz"


def write_batch(spark, folder, name, rows):
    spark.createDataFrame(rows, "px double, py double, s string").selectExpr("px", "py", "cast(s as timestamp_ntz) as t").coalesce(1).write.parquet(os.path.join(folder, name))


def rows_of(seed, n):
    r = random.Random(seed)
    return [(r.choice([r.gauss(0, 3), r.uniform(-25, 30)]), r.choice([r.gauss(2, 3), r.uniform(-25, 25)]), f"2020-01-{r.randint(1, 31):02d} 03:00:00") for _ in range(n)] + [(float("nan"), 0.0, "2020-01-01 00:00:00"), (1.0, 1.0, None)]


def stream_of(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(folder)


@pytest.mark.parametrize("clip", [False, True])
def test_equals_the_batch_ranking_after_every_batch(spark, scratch, clip):
    src = os.path.join(scratch, "in")
    out, ckpt = stream_location(spark, "test-incremental")
    for i in range(4):
        write_batch(spark, src, f"b{i}", rows_of(i, (400, 1, 30, 200)[i]))
        q = start_hot_cells_incremental(stream_of(spark, src), SPEC, out, ckpt, k=25, with_score=True, clip=clip)  # resumes
        q.awaitTermination()
        assert q.exception() is None
        every = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
        want = [tuple(r) for r in hot_cells(every, SPEC, k=25, with_score=True, clip=clip).collect()]
        got = [tuple(r) for r in read_latest(spark, out).orderBy("zscore", ascending=False).collect()]
        assert sorted(got) == sorted(want) and len(got) == 25
        changed = read_latest(spark, f"{out}/moments").first().changed
        if i == 1:  # one point (and rows without a cell): its neighbourhood at most, nothing if it is clipped
            assert int(not clip) <= changed <= 27
    assert read_latest(spark, f"{out}/leaders").count() <= 2 * 25 * 18


def test_without_a_deviation_the_order_is_by_coordinates(spark, scratch):
    """Equal counts in every cell of a small grid: no score, ranked by place."""
    spec = GridSpec(min_x=0, max_x=1, min_y=0, max_y=1, min_z=1, max_z=2, step_x=1.0, step_y=1.0)
    src = os.path.join(scratch, "in")
    rows = [(x + 0.5, y + 0.5, f"2020-01-0{z} 00:00:00") for x in (0, 1) for y in (0, 1) for z in (1, 2)]
    write_batch(spark, src, "b0", rows[4:])
    write_batch(spark, src, "b1", rows[:4])
    out, ckpt = stream_location(spark, "test-flat")
    q = start_hot_cells_incremental(stream_of(spark, src), spec, out, ckpt, k=3)
    q.awaitTermination()
    assert q.exception() is None
    every = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    assert [tuple(r) for r in read_latest(spark, out).collect()] == [tuple(r) for r in hot_cells(every, spec, k=3).collect()]


def test_contributions_against_counting(spark):
    r = np.random.default_rng(5)
    cells = np.unique(r.integers(-6, 8, (300, 3)), axis=0)
    n = r.integers(1, 9, len(cells))
    spec = GridSpec(min_x=-4, max_x=6, min_y=-5, max_y=5, min_z=-3, max_z=7, step_x=1.0, step_y=1.0)
    block = np.array([0, -1, 0])
    got, dn, ds = contributions(cells, n, block, spec, 4, 4)
    inside = lambda c: spec.min_x <= c[0] <= spec.max_x and spec.min_y <= c[1] <= spec.max_y and spec.min_z <= c[2] <= spec.max_z
    known = {tuple(c): int(m) for c, m in zip(cells.tolist(), n)}
    for x in range(0, 4):
        for y in range(-4, 0):
            for z in range(0, 4):
                near = [(x + i, y + j, z + k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
                s = sum(known.get(c, 0) for c in near if inside(c)) if inside((x, y, z)) else 0
                m = known.get((x, y, z), 0)
                hit = np.flatnonzero((got == (x, y, z)).all(axis=1))
                assert (int(dn[hit].sum()), int(ds[hit].sum())) == (m, s)
    assert all((0 <= c[0] < 4) and (-4 <= c[1] < 0) and (0 <= c[2] < 4) for c in got.tolist())
