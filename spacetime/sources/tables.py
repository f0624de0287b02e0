"""Point sets and zone sets derived from the benchmark parquet tables.

There is no taxi data in the benchmark, so the two analyses run over
columns of the given tables instead; every query reads whole tables, every
row becomes a point (nothing is filtered or sampled here).  The ``% 150`` on
``user_id`` folds ids into a 150-wide coordinate range; it is a coordinate,
not a row filter.

Point sets (``px, py`` doubles, ``t`` timestamp_ntz, plus a row key):

* ``events``     px = value,          py = user_id % 150,   t = ts
* ``lineitem``   px = l_quantity,     py = l_extendedprice, t = l_shipdate
* ``embeddings`` px = embedding[0],   py = embedding[1]     (no time)

Zone set ``nation_zones``: one rectangle per nation row, from its key k::

    x1 = (k % 5) * 10,  y1 = (k div 5) * 20000,  x2 = x1 + 12,  y2 = y1 + 24000

and its text ``"x1,y1,x2,y2"`` (integers, so the text is engine-independent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.functions.geometry import rectangle_text

# How the benchmark tables are read as points and zones.
EVENTS_Y_MOD = 150
ZONE_X_STEP = 10
ZONE_Y_STEP = 20000
ZONE_WIDTH = 12
ZONE_HEIGHT = 24000
ZONES_PER_ROW = 5
LONLAT_X0 = -74.5
LONLAT_X_DIV = 600.0
LONLAT_Y0 = 40.5
LONLAT_Y_DIV = 365.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_points_of(table(spark, sf_dir, "events"))


def events_points_of(ev: DataFrame) -> DataFrame:
    """``events`` rows (batch or stream) as points."""
    return ev.select(
        "event_id",
        F.col("value").alias("px"),
        (F.col("user_id") % EVENTS_Y_MOD).cast("double").alias("py"),
        F.col("ts").alias("t"),
    )


def events_lonlat_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` placed in the default study area (degrees)::

        px = -74.5 + value / 600,  py = 40.5 + (user_id % 150) / 365

    Values above ~480 and user ids with a remainder above 146 land east /
    north of the grid (they still count in the grid totals).
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        (F.lit(LONLAT_X0) + F.col("value") / F.lit(LONLAT_X_DIV)).alias("px"),
        (F.lit(LONLAT_Y0) + (F.col("user_id") % EVENTS_Y_MOD).cast("double") / F.lit(LONLAT_Y_DIV)).alias("py"),
        F.col("ts").alias("t"),
    )


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_points_of(table(spark, sf_dir, "lineitem"))


def lineitem_points_of(li: DataFrame) -> DataFrame:
    """``lineitem`` rows (batch or stream) as points."""
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("px"),
        F.col("l_extendedprice").alias("py"),
        F.col("l_shipdate").alias("t"),
    )


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    em = table(spark, sf_dir, "embeddings")
    return em.select(
        "vec_id",
        F.col("embedding")[0].cast("double").alias("px"),
        F.col("embedding")[1].cast("double").alias("py"),
    )


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("bigint")
    x1 = (k % ZONES_PER_ROW) * ZONE_X_STEP
    y1 = F.call_function("div", k, F.lit(ZONES_PER_ROW)) * ZONE_Y_STEP
    nz = table(spark, sf_dir, "nation").select(
        x1.alias("ix1"), y1.alias("iy1"), (x1 + ZONE_WIDTH).alias("ix2"), (y1 + ZONE_HEIGHT).alias("iy2")
    )
    return nz.select(
        rectangle_text("ix1", "iy1", "ix2", "iy2").alias("rectangle"),
        *[F.col(f"i{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")],
    )
