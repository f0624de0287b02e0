"""Points -> grid cells -> per-cell counts -> grid-wide moments.

Scale notes
-----------
* ``assign_cells`` is a projection: it fuses into the scan's whole-stage
  codegen and only the point columns it names are read.
* ``cell_counts`` is the only operator that touches every point.  It is a
  hash aggregate with a map-side partial step, so a hot cell (even one
  holding a third of all points) is combined inside each map task and the
  shuffle carries at most ``#map tasks x #distinct cells`` rows.
* ``grid_totals`` reads the (small) counts, never the points again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spacetime.functions.grid import GridSpec, cell_x, cell_y, cell_z, in_grid


def assign_cells(
    points: DataFrame,
    spec: GridSpec,
    x: str = "px",
    y: str = "py",
    t: str = "t",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Add the cell of every point: ``x bigint, y bigint, z int``."""
    return points.select(
        *keep,
        cell_x(x, spec).alias("x"),
        cell_y(y, spec).alias("y"),
        cell_z(t, spec).cast("int").alias("z"),
    )


def cell_counts(cells: DataFrame, spec: GridSpec | None = None, clip: bool = False) -> DataFrame:
    """Points per populated cell: ``x, y, z, n``.

    Rows with a NULL coordinate are not counted.  By default off-grid
    cells are kept (they take part in the grid totals, as in the original
    analysis); ``clip=True`` drops them first.
    """
    cond = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    if clip:
        if spec is None:
            raise ValueError("clip=True needs the grid spec")
        cond = cond & in_grid("x", "y", "z", spec)
    return cells.filter(cond).groupBy("x", "y", "z").agg(F.count(F.lit(1)).alias("n"))


def grid_totals(counts: DataFrame, spec: GridSpec) -> DataFrame:
    """One row of grid-wide moments over ``counts``.

    ``n_points``  all counted points (off-grid cells included unless clipped),
    ``n_cells``   populated cells,
    ``sum_sq``    sum of squared cell counts (double, summed exactly),
    ``mean``      n_points / grid volume (empty cells count as zero),
    ``s``         population std-dev over the whole grid volume (NULL if the
                  moments are inconsistent, which off-grid points can cause).
    """
    # Squares leave bigint from 3e9 points in one cell on: multiply and add as
    # decimals (exact to 38 digits), and go to double once.
    count = F.col("n").cast("decimal(19,0)")
    agg = counts.agg(
        F.sum(count).alias("points"),
        F.count(F.lit(1)).alias("n_cells"),
        F.sum((count * count).cast("decimal(38,0)")).cast("double").alias("sum_sq"),
    ).select(F.col("points").cast("bigint").alias("n_points"), "n_cells", "sum_sq")
    return with_moments(agg, spec)


def with_moments(totals: DataFrame, spec: GridSpec) -> DataFrame:
    """``totals`` (``n_points``, ``sum_sq``) with ``mean`` and ``s``."""
    n = float(spec.num_cells)
    mean = F.col("n_points").cast("double") / F.lit(n)
    var = F.col("sum_sq") / F.lit(n) - F.col("mean") * F.col("mean")
    # Off-grid counts enter n_points and sum_sq but not the grid volume, so
    # the "variance" can come out negative: no deviation (NULL), not NaN.
    return totals.withColumn("mean", mean).withColumn("s", F.when(var >= 0, F.sqrt(var)))
