"""CSV point / rectangle sources and CSV report sinks.

Input files have no header and are read with an explicit all-string schema
(no inference pass over the data).  Only the columns a query needs survive
the first projection, and Spark's CSV scan prunes the rest.

* point file:     ``;``-separated, >= 6 columns; column 1 is the pickup
  time ``yyyy-MM-dd HH:mm:ss``, column 5 the pickup point ``(x,y)``
  (possibly quoted).
* rectangle file: TAB-separated, column 0 is ``x1,y1,x2,y2``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Delimiters and column positions of the two input formats.
POINT_SEP = ";"
RECTANGLE_SEP = "\t"
POINT_TIME_POS = 1
POINT_POS = 5
RECTANGLE_POS = 0

POINT_FILE_SCHEMA = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(6)])
RECTANGLE_FILE_SCHEMA = T.StructType([T.StructField("_c0", T.StringType(), True)])


def read_points_csv(spark: SparkSession, path: str) -> DataFrame:
    """Point file -> ``pickup_time string, point string``."""
    raw = (
        spark.read.schema(POINT_FILE_SCHEMA)
        .option("sep", POINT_SEP)
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return raw.select(
        raw[f"_c{POINT_TIME_POS}"].alias("pickup_time"),
        raw[f"_c{POINT_POS}"].alias("point"),
    )


def read_rectangles_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rectangle file -> ``rectangle string``."""
    raw = (
        spark.read.schema(RECTANGLE_FILE_SCHEMA)
        .option("sep", RECTANGLE_SEP)
        .option("header", "false")
        .csv(path)
    )
    return raw.select(raw["_c0"].alias("rectangle"))


def write_points_csv(df: DataFrame, path: str, point: str = "point", time: str = "pickup_time") -> None:
    """A point file of ``df``: time and point in their columns, the others empty;
    values that hold the separator or a quote are quoted."""
    empty = F.lit("")
    cols: list[Column] = [empty] * len(POINT_FILE_SCHEMA)
    cols[POINT_TIME_POS], cols[POINT_POS] = F.col(time), F.col(point)
    out = df.select(*[c.alias(f"_c{i}") for i, c in enumerate(cols)])
    out.write.option("sep", POINT_SEP).option("header", "false").csv(path)


def write_rectangles_csv(df: DataFrame, path: str, rectangle: str = "rectangle", extra: tuple[str, ...] = ()) -> None:
    """A rectangle file of ``df``: the text first, then the columns ``extra``;
    values that hold a TAB or a quote are quoted."""
    out = df.select(F.col(rectangle).alias("_c0"), *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(extra, 1)])
    out.write.option("sep", RECTANGLE_SEP).option("header", "false").csv(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report's rows, its columns named and typed by ``schema``."""
    return spark.read.schema(schema).option("header", "false").csv(path)


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with header-less CSV.

    ``single_file`` coalesces to one partition first; use it only on small,
    already aggregated results (a per-zone count, a top-k).
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "false").csv(path)
