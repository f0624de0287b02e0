"""SQL functions vs the column functions, and a SQL-only hot-zone / cell query."""

import os
import random

import pytest
from pyspark.sql import functions as F

from spacetime.functions.geometry import contains_text, parse_point
from spacetime.functions.grid import GridSpec, cell_x, cell_y, cell_z, parse_time
from spacetime.functions.sql import register_sql_functions
from spacetime.plans.jobs import hot_zone_analysis


@pytest.fixture(scope="module")
def sqlfns(spark):
    return register_sql_functions(spark)


def test_registered_names(sqlfns):
    assert {"ST_Contains", "CalculateX", "CalculateY", "CalculateZ"} <= set(sqlfns)


def test_sql_functions_match_column_functions(spark, sqlfns):
    rnd = random.Random(5)
    rows = []
    for _ in range(300):
        x, y = round(rnd.uniform(-74.6, -73.6), rnd.choice([2, 4, 6])), round(rnd.uniform(40.4, 41.0), rnd.choice([2, 6]))
        rows.append((f"({x},{y})", f"2010-01-{rnd.randint(1, 31):02d} {rnd.randint(0, 23):02d}:00:00",
                     f"{x - 0.01},{y - 0.02},{x + rnd.choice([0.0, 0.01])},{y}"))
    df = spark.createDataFrame(rows, "point string, t string, rect string")
    df.createOrReplaceTempView("sqlfn_input")
    g = GridSpec.default()
    p = parse_point("point")
    want = df.select(
        cell_x(p["px"], g).alias("x"), cell_y(p["py"], g).alias("y"), cell_z(parse_time("t"), g).alias("z"),
        contains_text("rect", "point").alias("c"),
    ).collect()
    got = spark.sql(
        "SELECT CalculateX(point) AS x, CalculateY(point) AS y, CalculateZ(t) AS z, ST_Contains(rect, point) AS c "
        "FROM sqlfn_input"
    ).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_sql_functions_are_inlined(spark, sqlfns):
    spark.range(5).createOrReplaceTempView("sqlfn_ids")
    df = spark.sql("SELECT id FROM sqlfn_ids WHERE ST_Contains('0,0,3,3', concat('(', id, ',1)'))")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "substring_index" in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert [r.id for r in df.collect()] == [0, 1, 2, 3]


def test_sql_functions_fail_fast(spark, sqlfns):
    for expr in ("CalculateY('(-73.9)')", "CalculateX('(abc,40.7)')", "CalculateZ('2009-01-05')",
                 "ST_Contains('0,0,1', '(0,0)')"):
        with pytest.raises(Exception):
            spark.sql(f"SELECT {expr} AS v").collect()


def test_sql_hot_zone_query_matches_library(spark, sqlfns, scratch):
    from test_jobs_io import POINT_ROWS, RECT_ROWS, write_lines
    from spacetime.sources.csv import read_points_csv, read_rectangles_csv

    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    r = write_lines(os.path.join(scratch, "rects.tsv"), RECT_ROWS)
    read_points_csv(spark, p).createOrReplaceTempView("sql_points")
    read_rectangles_csv(spark, r).createOrReplaceTempView("sql_rects")
    got = spark.sql(
        "SELECT r.rectangle, COUNT(r.rectangle) AS value FROM sql_rects r JOIN sql_points p "
        "ON ST_Contains(r.rectangle, p.point) GROUP BY r.rectangle ORDER BY r.rectangle"
    ).collect()
    assert [tuple(x) for x in got] == [tuple(x) for x in hot_zone_analysis(spark, p, r).collect()]
