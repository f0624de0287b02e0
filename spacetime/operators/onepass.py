"""Both analyses' counts from one pass over the points.

A point feeds up to three kinds of partial counts: of its grid cell (hot cells),
of its cover cell (zones that hold the cell, see
:mod:`spacetime.operators.covers`), and of each zone whose edge runs through its
cover cell and that contains it.  The border zones of a cell are an array that a
broadcast join hands to the cell's points, so a point stays one row until its
keys are counted; every map task adds up its own counts before the one shuffle.
What is shuffled and written is a table of counts, from which both analyses are
finished without the points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spacetime.functions.grid import GridSpec, cell_x, cell_y, cell_z
from spacetime.operators import covers as C
from spacetime.operators.zones import ZONE_COLS, ZoneStats, _valid

GRID_CELL, COVER_CELL, ZONE = 0, 1, 2


class OnePass:
    """Counts of a point set for one grid and one zone set.

    ``counts`` is the table of tagged counts; ``zone_counts`` and ``cell_counts``
    read it, or any stored copy of it.  Raises ``ValueError`` if the zones have
    more border cells than ``broadcast_max_bytes`` allows: then two passes are
    the better plan.
    """

    def __init__(self, points: DataFrame, zones: DataFrame, spec: GridSpec, px: str = "px", py: str = "py", t: str = "t",
                 max_level: int = C.MAX_LEVEL, cells_per_zone: int = 32, spare_cells: int = 1 << 10, broadcast_max_bytes: int = 64 << 20):
        zs = zones.select("rectangle", *ZONE_COLS)
        stats = ZoneStats(zs)
        frame = C.Frame(tuple(a.low or 0.0 for a in stats.axes), tuple(a.high or 0.0 for a in stats.axes))
        self.spans = C.zone_spans(_valid(zs), frame)
        self.level, n_border = C.deepest_level(self.spans, float(cells_per_zone) * stats.n + spare_cells, max_level)
        if n_border * (stats.row_bytes + 16) > broadcast_max_bytes:
            raise ValueError(f"one pass needs at most {broadcast_max_bytes} bytes of border cells, these zones have {n_border * (stats.row_bytes + 16):.0f}")
        border = C.border_of(self.spans, self.level, C.EDGES).groupBy("_cell").agg(F.collect_list(F.struct(*C.EDGES)).alias("_zones"))
        keyed = C.point_keys(points.select(px, py, t), frame, px, py).withColumn("_cell", F.shiftright("_key", 2 * (C.DEPTH - self.level)))
        met = keyed.join(F.broadcast(border), "_cell", "left")

        def key(kind, x, y, z, rectangle):
            return F.struct(F.lit(kind).alias("kind"), x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), z.cast("int").alias("z"), rectangle.cast("string").alias("rectangle"))

        none = F.lit(None)
        near = F.when(stats.point_filter(px, py), F.array(key(COVER_CELL, F.col("_cell"), none, none, none))).otherwise(F.array().cast(f"array<{_KEY}>"))
        matched = F.filter("_zones", lambda z: F.col(px).between(z["x1"], z["x2"]) & F.col(py).between(z["y1"], z["y2"]))
        zone = F.coalesce(F.transform(matched, lambda z: key(ZONE, none, none, none, z["rectangle"])), F.array().cast(f"array<{_KEY}>"))
        keys = F.concat(F.array(key(GRID_CELL, cell_x(px, spec), cell_y(py, spec), cell_z(t, spec), none)), near, zone)
        self.counts = met.select(F.explode(keys).alias("k")).groupBy("k.kind", "k.x", "k.y", "k.z", "k.rectangle").agg(F.count(F.lit(1)).alias("n"))

    def zone_counts(self, counts: DataFrame) -> DataFrame:
        """``rectangle, value`` sorted by text."""
        cells = counts.where(F.col("kind") == COVER_CELL).select(F.col("x").alias("_cell"), F.col("n").alias("_n"))
        parts = counts.where(F.col("kind") == ZONE).select("rectangle", F.col("n").alias("_n"))
        return C.total_counts(cells, parts, self.spans, self.level).orderBy("rectangle")

    def cell_counts(self, counts: DataFrame) -> DataFrame:
        """``x, y, z, n`` of the populated grid cells."""
        known = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
        return counts.where((F.col("kind") == GRID_CELL) & known).select("x", "y", "z", "n")


_KEY = "struct<kind:int,x:bigint,y:bigint,z:int,rectangle:string>"
