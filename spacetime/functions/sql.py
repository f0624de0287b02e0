"""The point/cell functions as SQL functions, for users who write SQL.

``register_sql_functions(spark)`` creates session-temporary, SQL-bodied
functions (``CREATE TEMPORARY FUNCTION ... RETURN <expression>``).  Spark
inlines their bodies into the plan, so they are ordinary code-generated
expressions -- no UDF call per row, and predicates over them are optimised
like any other.  Semantics are those of the column functions in
:mod:`spacetime.functions.geometry` / :mod:`spacetime.functions.grid` in
strict mode: parentheses anywhere in a point are ignored; a missing field, a
malformed number or time and NULL text raise, in ANSI mode or not.

``ST_Contains`` as a *join* condition is a test of every pair, as any theta
join is.  For joins of large tables use :func:`zone_join_view`: each side is
parsed once and the tiles of :mod:`spacetime.operators.zones` pair them.

``spacetime_strip_parens(text)`` removes every parenthesis of a text.

The original application's ``trim`` function is *not* registered: it would
shadow the built-in ``trim`` for the whole session, and ``ST_Contains`` and
``CalculateX/Y`` strip parentheses themselves.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from spacetime.functions.geometry import STRICT
from spacetime.functions.grid import DEFAULT_STEP, TIME_FORMAT

# Helper names of this package.
FIELD_FN = "spacetime_field"
NUMBER_FN = "spacetime_number"
STRIP_FN = "spacetime_strip_parens"

# The SQL function names of the original application
# (Spark SQL function names are case-insensitive).
CONTAINS_FN = "ST_Contains"
CELL_X_FN = "CalculateX"
CELL_Y_FN = "CalculateY"
CELL_Z_FN = "CalculateZ"


def _definitions(step_x: float, step_y: float, time_format: str) -> list[str]:
    def num(text: str, i: int) -> str:
        return f"{NUMBER_FN}({FIELD_FN}({text}, {i}))"

    point = f"{STRIP_FN}(point)"
    return [
        f"""{STRIP_FN}(text STRING) RETURNS STRING
            RETURN replace(replace(text, '(', ''), ')', '')""",
        # i-th comma separated field (1-based); NULL text or a missing field raises
        f"""{FIELD_FN}(text STRING, i INT) RETURNS STRING
            RETURN CASE WHEN text IS NULL THEN raise_error('NULL text')
                        WHEN i = 1 OR octet_length(substring_index(text, ',', i - 1)) < octet_length(text)
                        THEN substring_index(substring_index(text, ',', i), ',', -1)
                        ELSE raise_error(concat('missing field ', i, ' in: ', text)) END""",
        # malformed text raises, in ANSI mode or not
        f"""{NUMBER_FN}(text STRING) RETURNS DOUBLE
            RETURN coalesce(try_cast(text AS DOUBLE), raise_error(concat('malformed number: ', text)))""",
        f"""{CONTAINS_FN}(rectangle STRING, point STRING) RETURNS BOOLEAN
            RETURN {num(point, 1)} BETWEEN {num('rectangle', 1)} AND {num('rectangle', 3)}
               AND {num(point, 2)} BETWEEN {num('rectangle', 2)} AND {num('rectangle', 4)}""",
        f"""{CELL_X_FN}(point STRING) RETURNS BIGINT
            RETURN floor(nullif({num(point, 1)}, double('NaN')) / CAST({float(step_x)!r} AS DOUBLE))""",
        f"""{CELL_Y_FN}(point STRING) RETURNS BIGINT
            RETURN floor(nullif({num(point, 2)}, double('NaN')) / CAST({float(step_y)!r} AS DOUBLE))""",
        f"""{CELL_Z_FN}(pickup_time STRING) RETURNS INT
            RETURN CASE WHEN pickup_time IS NULL THEN raise_error('NULL time text')
                        ELSE dayofmonth(coalesce(to_timestamp_ntz(pickup_time, '{time_format}'),
                                                 raise_error(concat('malformed time: ', pickup_time)))) END""",
    ]


def register_sql_functions(spark: SparkSession, step_x: float = DEFAULT_STEP, step_y: float | None = None,
                           time_format: str = TIME_FORMAT) -> list[str]:
    """Create the SQL functions in ``spark``'s session; return their names."""
    step_y = step_x if step_y is None else step_y
    names = []
    for d in _definitions(step_x, step_y, time_format):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {d}")
        names.append(d.split("(", 1)[0])
    return names


def zone_join_view(spark: SparkSession, points_view: str, rectangles_view: str, name: str, *, point_col: str = "point",
                   rectangle_col: str = "rectangle", mode: str = STRICT, **join_options) -> str:
    """Create the temp view ``name``: the pairs for which
    ``ST_Contains(rectangle, point)`` holds, without testing every pair.

    It has ``rectangle``, ``px``, ``py`` and the other columns of the point
    view, so that ``SELECT rectangle, COUNT(rectangle) AS value FROM name GROUP
    BY rectangle`` counts points per zone.
    """
    from spacetime.operators.zones import points_from_text, zone_point_pairs, zones_from_text

    raw = spark.table(points_view)
    points = points_from_text(raw, point_col, mode, keep=[c for c in raw.columns if c != point_col])
    zones = zones_from_text(spark.table(rectangles_view), rectangle_col, mode)
    zone_point_pairs(points, zones, **join_options).drop("x1", "y1", "x2", "y2").createOrReplaceTempView(name)
    return name
