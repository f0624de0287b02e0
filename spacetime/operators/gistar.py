"""Getis-Ord Gi* hot cells over a space-time grid.

    g(i) = (sum1 - mean * w) / (s * sqrt((n * w - w^2) / (n - 1)))

``n`` is the grid volume, ``mean``/``s`` the grid-wide moments (empty cells
count as zero), ``sum1`` the neighbourhood count and ``w`` the number of
in-grid neighbourhood slots (all weights are 1, so sum(w) = sum(w^2)).

Plan shape (one action, called by the user)::

    scan -> project cells -> partial agg -> shuffle -> counts
    counts -> block co-location -> scatter x27 -> partial agg -> shuffle -> neighbour sums
    counts -> global agg -> scalar subquery (mean, s)      [one row]
    sums + scalars -> score -> TakeOrderedAndProject(k)

The grid-wide scalars are a scalar subquery (computed once, inlined as a
value), not a join, and the counts exchange is reused by both branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spacetime.functions.grid import GridSpec, grid_point_filter
from spacetime.operators.cells import assign_cells, cell_counts, grid_totals
from spacetime.operators.neighbors import DEFAULT_BLOCK, neighbor_sums


def gi_star(sum1, w, mean, s, num_cells: int) -> Column:
    """Gi* z-score column; NULL when the denominator is zero or undefined."""
    sum1 = (F.col(sum1) if isinstance(sum1, str) else sum1).cast("double")
    w = (F.col(w) if isinstance(w, str) else w).cast("double")
    n = F.lit(float(num_cells))
    numer = sum1 - mean * w
    # n - 1 is 0 on a one-cell grid: both divisions give NULL, never raise.
    denom = s * F.sqrt(F.try_divide(n * w - w * w, F.lit(float(num_cells - 1))))
    return F.try_divide(numer, denom)


def score_cells(counts: DataFrame, spec: GridSpec, block: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Gi* of every populated in-grid cell: ``x, y, z, zscore``.

    ``block`` is the neighbour co-location block (see ``neighbor_sums``).
    """
    moments = grid_totals(counts, spec).select(F.struct("mean", "s").alias("m")).scalar()
    sums = neighbor_sums(counts, spec, block=block)
    return sums.select(
        "x", "y", "z", gi_star("sum1", "w", moments["mean"], moments["s"], spec.num_cells).alias("zscore")
    )


def top_cells(scored: DataFrame, k: int = 50, with_score: bool = False) -> DataFrame:
    """Top-k by score, ties broken by x, y, z; NULL scores last.

    Sort + project + limit is planned as ``TakeOrderedAndProject``: each
    task keeps its own k best rows and only k x #tasks rows meet at the end.
    Coordinates are reported as doubles, the score is hidden by default.
    """
    ordered = scored.orderBy(F.col("zscore").desc_nulls_last(), "x", "y", "z")
    cols = [F.col(c).cast("double").alias(c) for c in ("x", "y", "z")]
    if with_score:
        cols.append(F.col("zscore"))
    return ordered.select(*cols).limit(k)


def hot_cells(
    points: DataFrame,
    spec: GridSpec,
    k: int = 50,
    x: str = "px",
    y: str = "py",
    t: str = "t",
    clip: bool = False,
    with_score: bool = False,
    block: int | None = DEFAULT_BLOCK,
) -> DataFrame:
    """Points -> the k most significant hot cells (``x, y, z`` doubles).

    With ``clip=True`` the points are first cut to the grid's coordinate
    range (pushed to the scan), then counted in-grid only.
    """
    if clip:
        points = points.filter(grid_point_filter(x, y, spec))
    counts = cell_counts(assign_cells(points, spec, x, y, t), spec, clip=clip)
    return top_cells(score_cells(counts, spec, block), k, with_score)
