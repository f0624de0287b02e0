"""Query catalogue over the benchmark tables, with DuckDB oracle SQL.

Every entry reads whole tables (see :mod:`spacetime.sources.tables` for how
they are read as points and zones) and returns a lazy DataFrame.  The
oracle SQL of an entry computes the same rows with plain SQL: same column
names, same types, same floating-point order of operations, so values are
bit-identical.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.functions.geometry import contains_text, point_text
from spacetime.functions.grid import DAY_OF_YEAR, GridSpec, cell_id, cell_of_id, cell_x, cell_y, grid_point_filter, in_grid, is_adjacent, neighbor_weight
from spacetime.functions.sql import register_sql_functions, zone_join_view
from spacetime.operators.cells import assign_cells, cell_counts, grid_totals
from spacetime.operators.gistar import hot_cells, score_cells
from spacetime.operators.neighbors import adjacent_cell_pairs, box_sums, neighbor_sums
from spacetime.operators.zones import hot_zones, points_from_text, zone_point_pairs, zones_from_text
from spacetime.plans.jobs import run_batch
from spacetime.session import shared_folder
from spacetime.sources.clustered import read_cells, read_grid, write_clustered
from spacetime.sources.csv import read_points_csv, read_rectangles_csv, read_report, write_points_csv, write_rectangles_csv, write_report
from spacetime.sources.tables import (
    embedding_points,
    events_lonlat_points,
    events_points,
    events_points_of,
    lineitem_points,
    lineitem_points_of,
    nation_zones,
    table,
)
from spacetime.streaming.hotspots import read_parquet_stream, run_to_table, start_hot_cells, start_zone_counts
from spacetime.streaming.ranking import start_hot_cells_incremental

# Grids and the literal rectangle used by the catalogue.
EV_GRID = GridSpec(min_x=0, max_x=29, min_y=0, max_y=14, min_z=1, max_z=31, step_x=10.0, step_y=10.0)
LI_GRID = GridSpec(min_x=0, max_x=25, min_y=0, max_y=20, min_z=1, max_z=31, step_x=2.0, step_y=5000.0)
LI_NARROW = GridSpec(min_x=5, max_x=20, min_y=2, max_y=15, min_z=1, max_z=31, step_x=2.0, step_y=5000.0)
LI_DOY_GRID = GridSpec(min_x=0, max_x=25, min_y=0, max_y=20, min_z=1, max_z=366, step_x=2.0,
                       step_y=5000.0, z_unit=DAY_OF_YEAR)
EM_RECTANGLE = "-0.1,-0.2,0.15,0.1"
CLUSTER_RANGE = ((4, 13), (2, 9))  # columns and rows of cells
TOP_K = 50

Query = Callable[[SparkSession, str], DataFrame]


# ===================================================================== Spark


def _ev_cells(spark, d):
    return assign_cells(events_points(spark, d), EV_GRID, keep=("event_id",))


def _ev_counts(spark, d):
    return cell_counts(assign_cells(events_points(spark, d), EV_GRID), EV_GRID)


def _li_counts(spark, d, spec=LI_GRID, clip=False):
    return cell_counts(assign_cells(lineitem_points(spark, d), spec), spec, clip=clip)


def q_point_text_parse(spark, d):
    ev = events_points(spark, d).select("event_id", point_text("px", "py").alias("point"))
    return points_from_text(ev, "point", keep=["event_id"])


def q_zone_text_parse(spark, d):
    return zones_from_text(nation_zones(spark, d).select("rectangle"), "rectangle")


def q_point_in_zone_filter(spark, d):
    em = embedding_points(spark, d)
    return em.filter(contains_text(F.lit(EM_RECTANGLE), point_text("px", "py"))).select("vec_id", "px", "py")


def q_zone_point_pairs(spark, d):
    pairs = zone_point_pairs(lineitem_points(spark, d), nation_zones(spark, d))
    return pairs.select("rectangle", "l_orderkey", "l_linenumber")


def q_hot_zones(spark, d):
    return hot_zones(lineitem_points(spark, d), nation_zones(spark, d))


def q_hot_zones_tiled(spark, d):
    return hot_zones(lineitem_points(spark, d), nation_zones(spark, d), strategy="tiled_broadcast")


def q_hot_zones_shuffle(spark, d):
    return hot_zones(lineitem_points(spark, d), nation_zones(spark, d), strategy="tiled_shuffle", salt=4)


def q_hot_zones_duplicates(spark, d):
    nz = nation_zones(spark, d)
    return hot_zones(lineitem_points(spark, d), nz.unionAll(nz))


def q_hot_zones_text(spark, d):
    li = lineitem_points(spark, d).select(point_text("px", "py").alias("point"))
    pts = points_from_text(li, "point")
    zones = zones_from_text(nation_zones(spark, d).select("rectangle"), "rectangle")
    return hot_zones(pts, zones)


def _many_zones(nz: DataFrame) -> DataFrame:
    """More than 64 zones: the nation zones, copies shifted by half a zone, and
    copies without a left, upper or any edge."""
    shifted = nz.select("rectangle", *[(F.col(c) + s).alias(c) for c, s in (("x1", 6.0), ("y1", 12000.0), ("x2", 6.0), ("y2", 12000.0))])
    inf = F.lit(float("inf"))
    return (
        nz.unionAll(shifted)
        .unionAll(nz.withColumn("x1", -inf))
        .unionAll(nz.withColumn("y2", inf))
        .unionAll(nz.where("x1 = 0 AND y1 = 0").withColumns({"x1": -inf, "y1": -inf, "x2": inf, "y2": inf}))
    )


def q_hot_zones_unbounded(spark, d):
    return hot_zones(lineitem_points(spark, d), _many_zones(nation_zones(spark, d)))


def q_hot_zones_cover(spark, d):
    """Zones of any size and without edges, counted by cells they hold."""
    return hot_zones(lineitem_points(spark, d), _many_zones(nation_zones(spark, d)), strategy="cover")


def q_hot_zones_cover_shuffle(spark, d):
    """The same with the points shuffled by slots of a sample."""
    return hot_zones(lineitem_points(spark, d), _many_zones(nation_zones(spark, d)), strategy="cover", shuffle=True)


# ---- files in the original formats, written from the tables and read back


def _point_file(spark, d) -> str:
    """The ``events`` in degrees as a point file."""
    path = shared_folder(spark, "points-csv")
    ev = events_lonlat_points(spark, d).select(point_text("px", "py").alias("point"), F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("pickup_time"))
    write_points_csv(ev, path)
    return path


def _degree_zones(spark, d) -> DataFrame:
    """A rectangle in degrees per nation, and a remark with a comma, a TAB and quotes."""
    k = F.col("n_nationkey")
    x, y = (k % 5).cast("int"), F.expr("cast(n_nationkey div 5 as int)")
    text = F.concat(F.lit("-74."), 5 - x, F.lit(",40."), 50 + 8 * y, F.lit(",-74."), 4 - x, F.lit(",40."), 59 + 8 * y)
    return table(spark, d, "nation").select(text.alias("rectangle"), F.concat("n_name", F.lit(',\t"'), "n_nationkey", F.lit('"')).alias("remark"))


def _rectangle_file(spark, d) -> str:
    path = shared_folder(spark, "rectangles-tsv")
    write_rectangles_csv(_degree_zones(spark, d), path, extra=("remark",))
    return path


def q_point_file_scan(spark, d):
    """A point file read back: the pickup time's text and the point's numbers."""
    return points_from_text(read_points_csv(spark, _point_file(spark, d)), "point", keep=("pickup_time",))


def q_rectangle_file_scan(spark, d):
    """A rectangle file with quoted TAB text read back, and its numbers."""
    return zones_from_text(read_rectangles_csv(spark, _rectangle_file(spark, d)), "rectangle")


def q_report_file(spark, d):
    """The zone report written as part files (quoted commas) and read back."""
    path = shared_folder(spark, "report")
    write_report(q_hot_zones(spark, d), path)
    return read_report(spark, path, "rectangle string, value long")


def q_report_single_file(spark, d):
    """The zone report in one file, and in how many files it lies."""
    path = shared_folder(spark, "report")
    write_report(q_hot_zones(spark, d), path, single_file=True)
    rows = read_report(spark, path, "rectangle string, value long")
    return rows.withColumn("files", rows.select("_metadata.file_path").agg(F.countDistinct("file_path")).scalar())


def _batch(spark, d, shared_scan: bool):
    points, prefix = _point_file(spark, d), shared_folder(spark, "batch")
    paths = run_batch(spark, prefix, [("hotzoneanalysis", [points, _rectangle_file(spark, d)]), ("hotcellanalysis", [points])], shared_scan=shared_scan)
    zones = read_report(spark, paths[0], "rectangle string, value long").select(F.lit(0).alias("report"), "rectangle", F.col("value").cast("double").alias("x"), *[F.lit(None).cast("double").alias(c) for c in "yz"])
    return zones.unionByName(read_report(spark, paths[1], "x double, y double, z double").select(F.lit(1).alias("report"), F.lit(None).cast("string").alias("rectangle"), "x", "y", "z"))


def q_batch_reports(spark, d):
    """Both queries as a batch over files; the rows of both reports."""
    return _batch(spark, d, False)


def q_batch_reports_shared(spark, d):
    """The same batch with one scan of the point file."""
    return _batch(spark, d, True)


def q_hot_zones_sql(spark, d):
    """The zone count in SQL over two text views, joined by tiles."""
    points, rects, pairs = _view_name("point_text"), _view_name("rectangle_text"), _view_name("zone_pairs")
    lineitem_points(spark, d).select(point_text("px", "py").alias("point")).createOrReplaceTempView(points)
    nation_zones(spark, d).select("rectangle").createOrReplaceTempView(rects)
    zone_join_view(spark, points, rects, pairs, strategy="tiled_broadcast")
    return spark.sql(f"SELECT rectangle, COUNT(rectangle) AS value FROM {pairs} GROUP BY rectangle ORDER BY rectangle")


def q_adjacent_flags(spark, d):
    """``is_adjacent`` of every populated cell and the cells up to two steps
    away on x and y and one on z, in the grid or not."""
    step = lambda c, lo, hi: F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias(c)
    cells = _ev_counts(spark, d).select("x", "y", "z")
    near = cells.select("*", step("dx", -2, 2)).select("*", step("dy", -2, 2)).select("*", step("dz", -1, 1))
    to = [(F.col(c) + F.col(f"d{c}")).alias(f"n{c}") for c in ("x", "y", "z")]
    near = near.select("x", "y", "z", *to)
    return near.withColumn("adjacent", is_adjacent("x", "y", "z", "nx", "ny", "nz", EV_GRID))


def q_cell_assign(spark, d):
    return _ev_cells(spark, d)


def q_cell_assign_day_of_year(spark, d):
    return assign_cells(lineitem_points(spark, d), LI_DOY_GRID, keep=("l_orderkey", "l_linenumber"))


def q_cell_counts_events(spark, d):
    return _ev_counts(spark, d)


def q_cell_counts_lineitem(spark, d):
    return _li_counts(spark, d)


def q_grid_totals(spark, d):
    return grid_totals(_li_counts(spark, d), LI_GRID)


def q_cells_in_grid(spark, d):
    pts = lineitem_points(spark, d).filter(grid_point_filter("px", "py", LI_NARROW))
    cells = assign_cells(pts, LI_NARROW, keep=("l_orderkey", "l_linenumber"))
    return cells.filter(in_grid("x", "y", "z", LI_NARROW))


def q_cell_encode(spark, d):
    cells = _ev_cells(spark, d).filter(in_grid("x", "y", "z", EV_GRID))
    return cells.select("event_id", cell_id("x", "y", "z", EV_GRID).alias("cell_id"))


def q_cell_decode(spark, d):
    ids = q_cell_encode(spark, d)
    c = cell_of_id("cell_id", EV_GRID)
    return ids.select("event_id", "cell_id", c["x"].alias("x"), c["y"].alias("y"), c["z"].alias("z"))


def q_adjacent_cell_pairs(spark, d):
    return adjacent_cell_pairs(_ev_counts(spark, d).select("x", "y", "z"), EV_GRID)


def q_neighbor_sums(spark, d):
    return neighbor_sums(_ev_counts(spark, d), EV_GRID).select("x", "y", "z", "n", "sum1")


def q_neighbor_sums_box(spark, d):
    """The same sums axis by axis in blocks with a halo."""
    return box_sums(_ev_counts(spark, d), EV_GRID).select("x", "y", "z", "n", "sum1")


def q_clustered_cell_range(spark, d):
    """Cell counts written along the interleaved key; a rectangle of cells read back."""
    path = shared_folder(spark, "clustered-cells")
    write_clustered(_li_counts(spark, d), path)
    return read_cells(spark, path, *CLUSTER_RANGE).select("x", "y", "z", "n")


def q_clustered_grid(spark, d):
    """The same table's cells in a smaller grid."""
    path = shared_folder(spark, "clustered-cells")
    write_clustered(_li_counts(spark, d), path)
    return read_grid(spark, path, LI_NARROW).select("x", "y", "z", "n")


def q_clustered_point_range(spark, d):
    """Points written along the key of their cells; those of a rectangle of cells."""
    path, cell = shared_folder(spark, "clustered-points"), (cell_x("px", LI_GRID), cell_y("py", LI_GRID))
    write_clustered(lineitem_points(spark, d).select("l_orderkey", "l_linenumber", "px", "py"), path, *cell)
    return read_cells(spark, path, *CLUSTER_RANGE, cell=cell).select("l_orderkey", "l_linenumber", "px", "py")


def q_neighbor_weights(spark, d):
    cells = _ev_counts(spark, d).filter(in_grid("x", "y", "z", EV_GRID))
    return cells.select("x", "y", "z", neighbor_weight("x", "y", "z", EV_GRID).alias("w"))


def q_gi_star_events(spark, d):
    return score_cells(_ev_counts(spark, d), EV_GRID)


def q_gi_star_lineitem(spark, d):
    return score_cells(_li_counts(spark, d), LI_GRID)


def q_hot_cells_top50(spark, d):
    return hot_cells(events_points(spark, d), EV_GRID, k=TOP_K)


def q_hot_cells_lineitem_top50(spark, d):
    return hot_cells(lineitem_points(spark, d), LI_GRID, k=TOP_K, with_score=True)


def q_hot_cells_clipped(spark, d):
    return hot_cells(lineitem_points(spark, d), LI_NARROW, k=TOP_K, clip=True, with_score=True)


def q_hot_cells_default_grid(spark, d):
    """The original study grid (0.01 degree cells, days 1..31) over ``events``."""
    return hot_cells(events_lonlat_points(spark, d), GridSpec.default(), k=TOP_K, with_score=True)


def q_hot_cells_text(spark, d):
    """The whole text path: ``"(x,y)"`` and ``yyyy-MM-dd HH:mm:ss`` parsed back."""
    ev = events_points(spark, d).select(
        point_text("px", "py").alias("point"),
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("pickup_time"),
    )
    pts = points_from_text(ev, "point", time_col="pickup_time")
    return hot_cells(pts, EV_GRID, k=TOP_K)


def _view_name(stem: str) -> str:
    """A temp-view name of its own per call (calls may share a session)."""
    return f"spacetime_{stem}_{uuid.uuid4().hex[:10]}"


def q_cell_counts_sql(spark, d):
    """Cell counts written in SQL with the registered functions (0.01 cells)."""
    register_sql_functions(spark)
    ev = events_points(spark, d).select(
        point_text("px", "py").alias("point"), F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("pickup_time")
    )
    view = _view_name("events_text")
    ev.createOrReplaceTempView(view)
    return spark.sql(
        "SELECT x, y, z, COUNT(*) AS n FROM (SELECT CalculateX(point) AS x, CalculateY(point) AS y, "
        f"CalculateZ(pickup_time) AS z FROM {view}) c GROUP BY x, y, z"
    )


def q_point_in_zone_sql(spark, d):
    """``ST_Contains`` as a SQL filter over the embedding points."""
    register_sql_functions(spark)
    view = _view_name("embedding_text")
    embedding_points(spark, d).select("vec_id", point_text("px", "py").alias("point")).createOrReplaceTempView(view)
    return spark.sql(f"SELECT vec_id FROM {view} WHERE ST_Contains('{EM_RECTANGLE}', point)")


def q_hot_zones_stream(spark, d):
    """``hot_zones`` as a stream: lineitem parquet files -> running zone counts."""
    pts = lineitem_points_of(read_parquet_stream(spark, d, "lineitem.parquet"))
    zones = nation_zones(spark, d)
    return run_to_table(spark, lambda out, ck: start_zone_counts(pts, zones, out, ck), "hot_zones")


def q_hot_cells_stream(spark, d):
    """``hot_cells_top50`` as a stream: events parquet files -> running cell counts -> Gi* top-k."""
    pts = events_points_of(read_parquet_stream(spark, d, "events.parquet"))
    return run_to_table(spark, lambda out, ck: start_hot_cells(pts, EV_GRID, out, ck, k=TOP_K), "hot_cells")


def q_hot_cells_stream_incremental(spark, d):
    """The same stream ranked from the cells that each batch changed."""
    pts = events_points_of(read_parquet_stream(spark, d, "events.parquet"))
    return run_to_table(spark, lambda out, ck: start_hot_cells_incremental(pts, EV_GRID, out, ck, k=TOP_K), "hot_cells_incremental")


QUERIES: dict[str, Query] = {
    "point_text_parse": q_point_text_parse,
    "zone_text_parse": q_zone_text_parse,
    "point_in_zone_filter": q_point_in_zone_filter,
    "zone_point_pairs": q_zone_point_pairs,
    "hot_zones": q_hot_zones,
    "hot_zones_tiled": q_hot_zones_tiled,
    "hot_zones_shuffle": q_hot_zones_shuffle,
    "hot_zones_duplicates": q_hot_zones_duplicates,
    "hot_zones_text": q_hot_zones_text,
    "hot_zones_unbounded": q_hot_zones_unbounded,
    "hot_zones_cover": q_hot_zones_cover,
    "hot_zones_cover_shuffle": q_hot_zones_cover_shuffle,
    "hot_zones_sql": q_hot_zones_sql,
    "point_file_scan": q_point_file_scan,
    "rectangle_file_scan": q_rectangle_file_scan,
    "report_file": q_report_file,
    "report_single_file": q_report_single_file,
    "batch_reports": q_batch_reports,
    "batch_reports_shared": q_batch_reports_shared,
    "adjacent_flags": q_adjacent_flags,
    "cell_assign": q_cell_assign,
    "cell_assign_day_of_year": q_cell_assign_day_of_year,
    "cell_counts_events": q_cell_counts_events,
    "cell_counts_lineitem": q_cell_counts_lineitem,
    "grid_totals": q_grid_totals,
    "cells_in_grid": q_cells_in_grid,
    "cell_encode": q_cell_encode,
    "cell_decode": q_cell_decode,
    "adjacent_cell_pairs": q_adjacent_cell_pairs,
    "neighbor_sums": q_neighbor_sums,
    "neighbor_sums_box": q_neighbor_sums_box,
    "clustered_cell_range": q_clustered_cell_range,
    "clustered_grid": q_clustered_grid,
    "clustered_point_range": q_clustered_point_range,
    "neighbor_weights": q_neighbor_weights,
    "gi_star_events": q_gi_star_events,
    "gi_star_lineitem": q_gi_star_lineitem,
    "hot_cells_top50": q_hot_cells_top50,
    "hot_cells_lineitem_top50": q_hot_cells_lineitem_top50,
    "hot_cells_clipped": q_hot_cells_clipped,
    "hot_cells_text": q_hot_cells_text,
    "hot_cells_default_grid": q_hot_cells_default_grid,
    "cell_counts_sql": q_cell_counts_sql,
    "point_in_zone_sql": q_point_in_zone_sql,
    "hot_zones_stream": q_hot_zones_stream,
    "hot_cells_stream": q_hot_cells_stream,
    "hot_cells_stream_incremental": q_hot_cells_stream_incremental,
}


# ==================================================================== oracle
# DuckDB SQL over the registered views.  Literals are DOUBLE casts (a bare
# 0.01 would be a DECIMAL), integer cell bounds are plain integers.


def _dbl(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


EV_POINTS = (
    "SELECT event_id, value AS px, CAST(user_id % 150 AS DOUBLE) AS py, ts AS t FROM events"
)
EV_LONLAT_POINTS = (
    f"SELECT event_id, {_dbl(-74.5)} + value / {_dbl(600.0)} AS px, "
    f"{_dbl(40.5)} + CAST(user_id % 150 AS DOUBLE) / {_dbl(365.0)} AS py, ts AS t FROM events"
)
LI_POINTS = (
    "SELECT l_orderkey, l_linenumber, l_quantity AS px, l_extendedprice AS py, l_shipdate AS t FROM lineitem"
)
EM_POINTS = (
    "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS px, CAST(embedding[2] AS DOUBLE) AS py FROM embeddings"
)
NATION_ZONES = """
SELECT CAST(ix1 AS VARCHAR) || ',' || CAST(iy1 AS VARCHAR) || ',' ||
       CAST(ix2 AS VARCHAR) || ',' || CAST(iy2 AS VARCHAR) AS rectangle,
       CAST(ix1 AS DOUBLE) AS x1, CAST(iy1 AS DOUBLE) AS y1,
       CAST(ix2 AS DOUBLE) AS x2, CAST(iy2 AS DOUBLE) AS y2
FROM (SELECT CAST(n_nationkey AS BIGINT) % 5 * 10 AS ix1,
             CAST(n_nationkey AS BIGINT) // 5 * 20000 AS iy1,
             CAST(n_nationkey AS BIGINT) % 5 * 10 + 12 AS ix2,
             CAST(n_nationkey AS BIGINT) // 5 * 20000 + 24000 AS iy2
      FROM nation) k
"""


def _cells_sql(points_sql: str, g: GridSpec, keep: str = "") -> str:
    z = "dayofyear(t)" if g.z_unit == DAY_OF_YEAR else "day(t)"
    return (
        f"SELECT {keep + ', ' if keep else ''}"
        f"CAST(floor(px / {_dbl(g.step_x)}) AS BIGINT) AS x, "
        f"CAST(floor(py / {_dbl(g.step_y)}) AS BIGINT) AS y, "
        f"CAST({z} AS INTEGER) AS z FROM ({points_sql}) p"
    )


def _in_grid_sql(g: GridSpec, a: str = "") -> str:
    return (
        f"{a}x BETWEEN {g.min_x} AND {g.max_x} AND {a}y BETWEEN {g.min_y} AND {g.max_y} "
        f"AND {a}z BETWEEN {g.min_z} AND {g.max_z}"
    )


def _counts_sql(points_sql: str, g: GridSpec, clip: bool = False) -> str:
    where = "x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL"
    if clip:
        where += " AND " + _in_grid_sql(g)
    return f"SELECT x, y, z, COUNT(*) AS n FROM ({_cells_sql(points_sql, g)}) c WHERE {where} GROUP BY x, y, z"


def _totals_sql(counts_sql: str, g: GridSpec) -> str:
    n = _dbl(g.num_cells)
    return f"""
SELECT n_points, n_cells, sum_sq, mean,
       CASE WHEN sum_sq / {n} - mean * mean >= 0
            THEN sqrt(sum_sq / {n} - mean * mean) END AS s
FROM (SELECT n_points, n_cells, sum_sq, CAST(n_points AS DOUBLE) / {n} AS mean
      FROM (SELECT CAST(SUM(n) AS BIGINT) AS n_points, COUNT(*) AS n_cells,
                   CAST(SUM(CAST(n AS HUGEINT) * n) AS DOUBLE) AS sum_sq FROM ({counts_sql}) c0) t0) t1
"""


_OFFSETS = "(VALUES (-1), (0), (1))"


def _weight_sql(g: GridSpec, a: str = "") -> str:
    def axis(c, lo, hi):
        return (f"(3 - CASE WHEN {a}{c} = {lo} THEN 1 ELSE 0 END "
                f"- CASE WHEN {a}{c} = {hi} THEN 1 ELSE 0 END)")

    return (f"CAST({axis('x', g.min_x, g.max_x)} * {axis('y', g.min_y, g.max_y)} * "
            f"{axis('z', g.min_z, g.max_z)} AS BIGINT)")


def _neighbor_sql(counts_sql: str, g: GridSpec) -> str:
    """Populated in-grid cells with n, sum1 (brute force over 27 offsets)."""
    return f"""
SELECT c.x + ox.d AS x, c.y + oy.d AS y, CAST(c.z + oz.d AS INTEGER) AS z,
       CAST(SUM(CASE WHEN ox.d = 0 AND oy.d = 0 AND oz.d = 0 THEN c.n END) AS BIGINT) AS n,
       CAST(SUM(c.n) AS BIGINT) AS sum1
FROM ({counts_sql}) c, {_OFFSETS} ox(d), {_OFFSETS} oy(d), {_OFFSETS} oz(d)
WHERE {_in_grid_sql(g, 'c.')}
  AND c.x + ox.d BETWEEN {g.min_x} AND {g.max_x}
  AND c.y + oy.d BETWEEN {g.min_y} AND {g.max_y}
  AND c.z + oz.d BETWEEN {g.min_z} AND {g.max_z}
GROUP BY 1, 2, 3
HAVING SUM(CASE WHEN ox.d = 0 AND oy.d = 0 AND oz.d = 0 THEN c.n END) IS NOT NULL
"""


def _scores_sql(points_sql: str, g: GridSpec, clip: bool = False) -> str:
    counts = _counts_sql(points_sql, g, clip)
    n = _dbl(g.num_cells)
    n1 = _dbl(g.num_cells - 1)
    return f"""
SELECT s.x, s.y, s.z,
       (CAST(s.sum1 AS DOUBLE) - m.mean * CAST(s.w AS DOUBLE))
       / NULLIF(m.s * sqrt(({n} * CAST(s.w AS DOUBLE) - CAST(s.w AS DOUBLE) * CAST(s.w AS DOUBLE))
                           / NULLIF({n1}, 0)), 0)
       AS zscore
FROM (SELECT x, y, z, sum1, {_weight_sql(g)} AS w FROM ({_neighbor_sql(counts, g)}) nb) s,
     ({_totals_sql(counts, g)}) m
"""


def _top_sql(points_sql: str, g: GridSpec, clip: bool = False, with_score: bool = False) -> str:
    score = ", zscore" if with_score else ""
    return f"""
SELECT CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) AS z{score}
FROM ({_scores_sql(points_sql, g, clip)}) sc
ORDER BY zscore DESC NULLS LAST, sc.x, sc.y, sc.z
LIMIT {TOP_K}
"""


def _pairs_sql(zones_sql: str = NATION_ZONES) -> str:
    return f"""
SELECT zn.rectangle, li.l_orderkey, li.l_linenumber
FROM ({LI_POINTS}) li JOIN ({zones_sql}) zn
  ON li.px BETWEEN zn.x1 AND zn.x2 AND li.py BETWEEN zn.y1 AND zn.y2
"""


def _hot_zones_sql(zones_sql: str = NATION_ZONES) -> str:
    return f"""
SELECT rectangle, COUNT(rectangle) AS value FROM ({_pairs_sql(zones_sql)}) pr
GROUP BY rectangle ORDER BY rectangle
"""


def _many_zones_sql() -> str:
    inf = "CAST('Infinity' AS DOUBLE)"
    nz = f"({NATION_ZONES})"
    return f"""
SELECT rectangle, x1, y1, x2, y2 FROM {nz} a
UNION ALL SELECT rectangle, x1 + 6.0, y1 + 12000.0, x2 + 6.0, y2 + 12000.0 FROM {nz} b
UNION ALL SELECT rectangle, -{inf}, y1, x2, y2 FROM {nz} c
UNION ALL SELECT rectangle, x1, y1, x2, {inf} FROM {nz} e
UNION ALL SELECT rectangle, -{inf}, -{inf}, {inf}, {inf} FROM {nz} f WHERE x1 = 0 AND y1 = 0
"""


DEGREE_ZONES = """
SELECT rectangle, CAST(string_split(rectangle, ',')[1] AS DOUBLE) AS x1, CAST(string_split(rectangle, ',')[2] AS DOUBLE) AS y1,
       CAST(string_split(rectangle, ',')[3] AS DOUBLE) AS x2, CAST(string_split(rectangle, ',')[4] AS DOUBLE) AS y2
FROM (SELECT '-74.' || (5 - n_nationkey % 5) || ',40.' || (50 + 8 * (n_nationkey // 5)) || ',-74.' || (4 - n_nationkey % 5) || ',40.' || (59 + 8 * (n_nationkey // 5)) AS rectangle FROM nation) r
"""


def _batch_sql() -> str:
    return f"""
SELECT 0 AS report, rectangle, CAST(COUNT(*) AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y, CAST(NULL AS DOUBLE) AS z
FROM ({EV_LONLAT_POINTS}) p JOIN ({DEGREE_ZONES}) zn ON p.px BETWEEN zn.x1 AND zn.x2 AND p.py BETWEEN zn.y1 AND zn.y2
GROUP BY rectangle
UNION ALL SELECT 1, CAST(NULL AS VARCHAR), x, y, z FROM ({_top_sql(EV_LONLAT_POINTS, GridSpec.default())}) c
"""


def _adjacent_flags_sql() -> str:
    g = EV_GRID
    return f"""
SELECT x, y, z, nx, ny, nz,
       ({_in_grid_sql(g)}) AND nx BETWEEN {g.min_x} AND {g.max_x} AND ny BETWEEN {g.min_y} AND {g.max_y}
       AND nz BETWEEN {g.min_z} AND {g.max_z}
       AND abs(x - nx) <= 1 AND abs(y - ny) <= 1 AND abs(z - nz) <= 1 AS adjacent
FROM (SELECT x, y, z, x + dx.d AS nx, y + dy.d AS ny, CAST(z + dz.d AS INTEGER) AS nz
      FROM ({_ev_counts_sql()}) c, (VALUES (-2), (-1), (0), (1), (2)) dx(d), (VALUES (-2), (-1), (0), (1), (2)) dy(d),
           (VALUES (-1), (0), (1)) dz(d)) p
"""


def _range_sql(x: str, y: str) -> str:
    (x0, x1), (y0, y1) = CLUSTER_RANGE
    return f"{x} BETWEEN {x0} AND {x1} AND {y} BETWEEN {y0} AND {y1}"


def _ev_counts_sql() -> str:
    return _counts_sql(EV_POINTS, EV_GRID)


def _ev_encode_sql() -> str:
    g = EV_GRID
    return (
        f"SELECT event_id, CAST((z - {g.min_z}) * {g.layer} + ({g.max_y} - y) * {g.width} "
        f"+ (x - {g.min_x} + 1) AS BIGINT) AS cell_id "
        f"FROM ({_cells_sql(EV_POINTS, g, 'event_id')}) c WHERE {_in_grid_sql(g)}"
    )


def _ev_decode_sql() -> str:
    g = EV_GRID
    return (
        f"SELECT event_id, cell_id, "
        f"CAST({g.min_x} + ((cell_id - 1) % {g.layer}) % {g.width} AS BIGINT) AS x, "
        f"CAST({g.max_y} - ((cell_id - 1) % {g.layer}) // {g.width} AS BIGINT) AS y, "
        f"CAST((cell_id - 1) // {g.layer} + {g.min_z} AS INTEGER) AS z "
        f"FROM ({_ev_encode_sql()}) e"
    )


def _adjacent_sql() -> str:
    g = EV_GRID
    cells = f"SELECT x, y, z FROM ({_ev_counts_sql()}) c WHERE {_in_grid_sql(g)}"
    return f"""
SELECT a.x, a.y, a.z, b.x AS nx, b.y AS ny, b.z AS nz
FROM ({cells}) a JOIN ({cells}) b
  ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.z - b.z) <= 1
"""


ORACLE_SQL: dict[str, str] = {
    "point_text_parse": "SELECT event_id, value AS px, CAST(user_id % 150 AS DOUBLE) AS py FROM events",
    "zone_text_parse": f"SELECT rectangle, x1, y1, x2, y2 FROM ({NATION_ZONES}) z",
    "point_in_zone_filter": (
        f"SELECT vec_id, px, py FROM ({EM_POINTS}) e "
        f"WHERE px BETWEEN {_dbl(-0.1)} AND {_dbl(0.15)} AND py BETWEEN {_dbl(-0.2)} AND {_dbl(0.1)}"
    ),
    "zone_point_pairs": _pairs_sql(),
    "hot_zones": _hot_zones_sql(),
    "hot_zones_tiled": _hot_zones_sql(),
    "hot_zones_shuffle": _hot_zones_sql(),
    "hot_zones_duplicates": _hot_zones_sql(f"SELECT * FROM ({NATION_ZONES}) a UNION ALL SELECT * FROM ({NATION_ZONES}) b"),
    "hot_zones_text": _hot_zones_sql(),
    "hot_zones_unbounded": _hot_zones_sql(_many_zones_sql()),
    "hot_zones_cover": _hot_zones_sql(_many_zones_sql()),
    "hot_zones_cover_shuffle": _hot_zones_sql(_many_zones_sql()),
    "hot_zones_sql": _hot_zones_sql(),
    "point_file_scan": f"SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS pickup_time, px, py FROM ({EV_LONLAT_POINTS}) p",
    "rectangle_file_scan": DEGREE_ZONES,
    "report_file": _hot_zones_sql(),
    "report_single_file": f"SELECT rectangle, value, CAST(1 AS BIGINT) AS files FROM ({_hot_zones_sql()}) r",
    "batch_reports": _batch_sql(),
    "batch_reports_shared": _batch_sql(),
    "adjacent_flags": _adjacent_flags_sql(),
    "cell_assign": _cells_sql(EV_POINTS, EV_GRID, "event_id"),
    "cell_assign_day_of_year": _cells_sql(LI_POINTS, LI_DOY_GRID, "l_orderkey, l_linenumber"),
    "cell_counts_events": _ev_counts_sql(),
    "cell_counts_lineitem": _counts_sql(LI_POINTS, LI_GRID),
    "grid_totals": _totals_sql(_counts_sql(LI_POINTS, LI_GRID), LI_GRID),
    "cells_in_grid": (
        f"SELECT * FROM ({_cells_sql(LI_POINTS, LI_NARROW, 'l_orderkey, l_linenumber')}) c "
        f"WHERE {_in_grid_sql(LI_NARROW)}"
    ),
    "cell_encode": _ev_encode_sql(),
    "cell_decode": _ev_decode_sql(),
    "adjacent_cell_pairs": _adjacent_sql(),
    "neighbor_sums": _neighbor_sql(_ev_counts_sql(), EV_GRID),
    "neighbor_sums_box": _neighbor_sql(_ev_counts_sql(), EV_GRID),
    "clustered_cell_range": f"SELECT x, y, z, n FROM ({_counts_sql(LI_POINTS, LI_GRID)}) c WHERE {_range_sql('x', 'y')}",
    "clustered_grid": f"SELECT x, y, z, n FROM ({_counts_sql(LI_POINTS, LI_GRID)}) c WHERE {_in_grid_sql(LI_NARROW)}",
    "clustered_point_range": (
        f"SELECT l_orderkey, l_linenumber, px, py FROM ({LI_POINTS}) p "
        f"WHERE {_range_sql(f'floor(px / {_dbl(LI_GRID.step_x)})', f'floor(py / {_dbl(LI_GRID.step_y)})')}"
    ),
    "neighbor_weights": (
        f"SELECT x, y, z, {_weight_sql(EV_GRID)} AS w FROM ({_ev_counts_sql()}) c WHERE {_in_grid_sql(EV_GRID)}"
    ),
    "gi_star_events": _scores_sql(EV_POINTS, EV_GRID),
    "gi_star_lineitem": _scores_sql(LI_POINTS, LI_GRID),
    "hot_cells_top50": _top_sql(EV_POINTS, EV_GRID),
    "hot_cells_lineitem_top50": _top_sql(LI_POINTS, LI_GRID, with_score=True),
    "hot_cells_clipped": _top_sql(LI_POINTS, LI_NARROW, clip=True, with_score=True),
    "hot_cells_text": _top_sql(EV_POINTS, EV_GRID),
    "hot_cells_default_grid": _top_sql(EV_LONLAT_POINTS, GridSpec.default(), with_score=True),
    "cell_counts_sql": _counts_sql(EV_POINTS, GridSpec(0, 0, 0, 0, 1, 1, step_x=0.01, step_y=0.01)),
    "point_in_zone_sql": (
        f"SELECT vec_id FROM ({EM_POINTS}) e "
        f"WHERE px BETWEEN {_dbl(-0.1)} AND {_dbl(0.15)} AND py BETWEEN {_dbl(-0.2)} AND {_dbl(0.1)}"
    ),
    "hot_zones_stream": _hot_zones_sql(),
    "hot_cells_stream": _top_sql(EV_POINTS, EV_GRID),
    "hot_cells_stream_incremental": _top_sql(EV_POINTS, EV_GRID),
}
