"""Physical plan shape of the flagship queries."""

import contextlib
import io

import pytest

from spacetime.plans.catalog import QUERIES

D = "/root/testdata/sf0.001"


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["hot_cells_top50", "hot_zones", "hot_zones_tiled", "hot_zones_text", "hot_cells_text"])
def test_no_python_no_cartesian(spark, name):
    plan = formatted(QUERIES[name](spark, D))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert bad not in plan


def test_top_k_is_take_ordered(spark):
    plan = formatted(QUERIES["hot_cells_top50"](spark, D))
    assert "TakeOrderedAndProject" in plan


def test_counts_scanned_once(spark):
    """Totals subquery reuses the counts exchange of the main branch."""
    df = QUERIES["hot_cells_top50"](spark, D)
    plan = executed(df)
    assert "ReusedExchange" in plan
    assert "ReusedSubquery" in plan


def test_scan_prunes_columns(spark):
    plan = formatted(QUERIES["hot_cells_top50"](spark, D))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = formatted(QUERIES["hot_zones"](spark, D))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan


def test_zone_strategies(spark):
    assert "BroadcastNestedLoopJoin" in formatted(QUERIES["hot_zones"](spark, D))
    tiled = formatted(QUERIES["hot_zones_tiled"](spark, D))
    assert "BroadcastHashJoin" in tiled and "BroadcastNestedLoopJoin" not in tiled
    assert "SortMergeJoin" in formatted(QUERIES["hot_zones_shuffle"](spark, D))


def test_partial_aggregation_before_shuffle(spark):
    plan = formatted(QUERIES["hot_zones"](spark, D))
    assert "partial_count" in plan


def test_text_parse_not_duplicated(spark):
    """No inferred filter re-runs the text parse below the generator."""
    plan = executed(QUERIES["hot_zones_text"](spark, D))
    assert "substring_index" in plan
    assert [line for line in plan.splitlines() if "Filter" in line and "substring_index" in line] == []


def test_zone_bounding_box_reaches_the_scan(spark):
    plan = formatted(QUERIES["hot_zones"](spark, D))
    assert "GreaterThanOrEqual(l_quantity,0.0)" in plan and "LessThanOrEqual(l_extendedprice,104000.0)" in plan


def test_clipped_grid_range_reaches_the_scan(spark):
    plan = formatted(QUERIES["hot_cells_clipped"](spark, D))
    assert "GreaterThanOrEqual(l_quantity,8.0)" in plan and "LessThanOrEqual(l_extendedprice,85000.0)" in plan


def test_neighbours_colocated_before_scatter(spark):
    plan = formatted(QUERIES["gi_star_lineitem"](spark, D))
    assert "REPARTITION_BY_NUM" in plan  # cells hashed by their spatial block
    assert "partial_sum" in plan  # the scatter is combined before its shuffle
    assert plan.count("Scan parquet") >= 1 and "CartesianProduct" not in plan


def test_neighbour_partitions_follow_the_session_not_the_cores(spark):
    from spacetime.operators.neighbors import neighbor_sums
    from spacetime.plans.catalog import LI_GRID

    counts = spark.createDataFrame([(1, 1, 1, 5)], "x long, y long, z int, n long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert ", 64), REPARTITION_BY_NUM" in formatted(neighbor_sums(counts, LI_GRID))
        assert ", 500), REPARTITION_BY_NUM" in formatted(neighbor_sums(counts, LI_GRID, partitions=500))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sql_zone_join_tests_no_pairs(spark):
    plan = formatted(QUERIES["hot_zones_sql"](spark, D))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_benchmark_zones_use_tiles_on_both_axes(spark):
    from spacetime.operators.zones import plan_tiles, zone_tiles
    from spacetime.sources.tables import nation_zones

    zones = nation_zones(spark, D)
    tiles = zone_tiles(zones, plan_tiles(zones)).select("tx", "ty").distinct().collect()
    assert len({t.tx for t in tiles}) > 1 and len({t.ty for t in tiles}) > 1


def test_only_hot_tiles_are_replicated(spark):
    from pyspark.sql import functions as F

    from spacetime.operators.zones import hot_tiles, plan_tiles, point_tiles

    zones = spark.range(400).select((F.col("id") % 20 * 5.0).alias("x1"), (F.floor(F.col("id") / 20) * 5.0).alias("y1")).withColumns({"x2": F.col("x1") + 5, "y2": F.col("y1") + 5})
    spread = spark.range(20000).select((F.rand(1) * 100).alias("px"), (F.rand(2) * 100).alias("py"))
    points = spread.unionAll(spark.range(10000).select((F.lit(52.0) + F.rand(3)).alias("px"), (F.lit(52.0) + F.rand(4)).alias("py")))
    hot = hot_tiles(point_tiles(points, plan_tiles(zones)).select("lx", "ly", "tx", "ty"), 64, 8).collect()
    assert len(hot) == 1 and hot[0]["_parts"] == 8
