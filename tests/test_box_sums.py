import random

import pytest
from pyspark.sql import functions as F

from spacetime.functions.grid import GridSpec
from spacetime.operators.neighbors import box_sums, halo_blocks, neighbor_sums

SPEC = GridSpec(min_x=-70, max_x=90, min_y=-40, max_y=60, min_z=1, max_z=31, step_x=1.0, step_y=1.0)


def counts_df(spark, seed, n=4000):
    r = random.Random(seed)
    cells = {(r.randint(-75, 95), r.randint(-45, 65), r.randint(0, 33)): r.randint(1, 10**12) for _ in range(n)}
    cells |= {(x, y, z): 1 + x * x for x in range(28, 37) for y in range(-3, 4) for z in range(1, 32)}
    return spark.createDataFrame([(*c, n) for c, n in cells.items()], "x long, y long, z int, n long")


@pytest.mark.parametrize("block,depth", [(32, 64), (4, 3), (2, 2)])
def test_equal_to_the_scattered_sums(spark, block, depth):
    counts = counts_df(spark, 1)
    want = sorted(map(tuple, neighbor_sums(counts, SPEC).select("x", "y", "z", "n", "sum1", "w").collect()))
    got = box_sums(counts, SPEC, block, depth)
    assert got.columns == ["x", "y", "z", "n", "sum1", "w"]
    assert got.schema["z"].dataType.simpleString() == "int"
    assert sorted(map(tuple, got.collect())) == want


def test_one_shuffle_of_few_rows(spark):
    """A dense plane of cells: rows shuffled per cell, and no shuffle but one."""
    cells = spark.range(256 * 256).select((F.col("id") % 256).alias("x"), F.floor(F.col("id") / 256).alias("y"), F.lit(3).alias("z"), F.lit(1).cast("long").alias("n"))
    assert halo_blocks(cells.withColumn("z", F.col("z").cast("long"))).count() / (256 * 256) < 1.4
    spec = GridSpec(min_x=0, max_x=255, min_y=0, max_y=255, min_z=1, max_z=31, step_x=1.0, step_y=1.0)
    df = box_sums(cells, spec)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert df.agg(F.sum("sum1")).first()[0] == (3 * 256 - 2) ** 2


def test_empty_and_small_blocks(spark):
    counts = counts_df(spark, 2, 10)
    assert box_sums(counts.limit(0), SPEC).collect() == []
    with pytest.raises(ValueError):
        box_sums(counts, SPEC, block=1)
