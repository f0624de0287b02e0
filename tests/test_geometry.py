import pytest
from pyspark.sql import functions as F

from spacetime.functions.geometry import (
    contains,
    contains_text,
    parse_point,
    parse_rectangle,
    point_text,
    rectangle_text,
    strip_parens,
)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_strip_parens_removes_every_paren(spark):
    assert one(spark, strip_parens(F.lit("((1,2))")).alias("s"))["s"] == "1,2"


def test_parse_point_basic_and_extra_elements(spark):
    r = one(spark, parse_point(F.lit("(-73.991957,40.721567)")).alias("p"))["p"]
    assert (r.px, r.py) == (-73.991957, 40.721567)
    # a third numeric element is ignored
    r = one(spark, parse_point(F.lit("(-73.9,40.7,1)")).alias("p"))["p"]
    assert (r.px, r.py) == (-73.9, 40.7)


def test_parse_point_blanks_accepted(spark):
    r = one(spark, parse_point(F.lit("( 1.5 , 2 )")).alias("p"))["p"]
    assert (r.px, r.py) == (1.5, 2.0)


@pytest.mark.parametrize("text", ["(abc,40.7)", "(-73.9)", None])
def test_parse_point_strict_fails(spark, text):
    with pytest.raises(Exception):
        one(spark, parse_point(F.lit(text).cast("string")).alias("p"))


@pytest.mark.parametrize("text", ["(abc,40.7)", "(-73.9)", None])
def test_parse_point_permissive_nulls(spark, text):
    r = one(spark, parse_point(F.lit(text).cast("string"), mode="permissive").alias("p"))["p"]
    assert r is None or r.px is None or r.py is None


def test_parse_rectangle(spark):
    r = one(spark, parse_rectangle(F.lit("0,1.5,-2,3")).alias("r"))["r"]
    assert (r.x1, r.y1, r.x2, r.y2) == (0.0, 1.5, -2.0, 3.0)


def test_text_round_trip(spark):
    r = one(
        spark,
        point_text(F.lit(-73.25), F.lit(40.5)).alias("p"),
        rectangle_text(F.lit(1), F.lit(2), F.lit(3), F.lit(4)).alias("r"),
    )
    assert r["p"] == "(-73.25,40.5)"
    assert r["r"] == "1,2,3,4"


@pytest.mark.parametrize(
    "px,py,expected",
    [(0, 0, True), (10, 10, True), (5, 5, True), (10.0001, 3, False), (-0.0001, 5, False), (3, 10.5, False)],
)
def test_contains_closed_edges(spark, px, py, expected):
    c = contains(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0), F.lit(float(px)), F.lit(float(py)))
    assert one(spark, c.alias("c"))["c"] is expected


def test_reversed_corners_contain_nothing(spark):
    c = contains_text(F.lit("10,10,0,0"), F.lit("(5,5)"))
    assert one(spark, c.alias("c"))["c"] is False


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_means_strict_in_every_session(spark, ansi):
    from spacetime.functions.grid import parse_time
    from spacetime.functions.sql import register_sql_functions
    from spacetime.operators.zones import points_from_text, zones_from_text

    register_sql_functions(spark)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        bad = spark.createDataFrame([("(abc,1)", "1,2,x,4", "2009-13-45 00:00:00")], "p string, r string, t string")
        for df in (points_from_text(bad, "p"), zones_from_text(bad, "r"), bad.select(parse_time("t"))):
            with pytest.raises(Exception):
                df.collect()
        for sql in ("ST_Contains('1,2,x,4', '(1,3)')", "CalculateX('(abc,1)')", "CalculateY('(1,abc)')", "CalculateZ('2009-13-45 00:00:00')"):
            with pytest.raises(Exception):
                spark.range(1).selectExpr(sql).collect()
        good = spark.range(1).selectExpr("ST_Contains('0,0,2,2', '(1,1)') AS a", "CalculateX('(0.055,1)') AS x", "CalculateZ('2009-01-15 00:00:00') AS z", "spacetime_strip_parens('((a),b)') AS s").first()
        assert tuple(good) == (True, 5, 15, "a,b")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
