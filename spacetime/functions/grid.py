"""Space-time grid: cell assignment, cell ids, adjacency and weights.

A grid is a box of integer cells ``x in [min_x, max_x]``, ``y in [min_y,
max_y]``, ``z in [min_z, max_z]``.  A point lands in cell
``(floor(px / step_x), floor(py / step_y), day(t))``.

The division is by a DOUBLE step, on purpose: with ``step = 0.01`` an
exact multiple such as -74.43 lands in -7444, one cell low, and that is
the placement every consumer of these grids has always seen.  Multiplying
by 100 instead would misplace a *different* set of edges.

Cell ids are 1-based and laid out z-major, then y descending, then x
ascending::

    id = (z - min_z) * L + (max_y - y) * W + (x - min_x + 1)
    W = max_x - min_x + 1,  H = max_y - min_y + 1,  L = W * H

All helpers return Columns; nothing is collected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from spacetime.functions._util import as_col

DAY_OF_MONTH = "day_of_month"
DAY_OF_YEAR = "day_of_year"

# The default study area and grid of the original application.
# Longitude -74.50 .. -73.70, latitude 40.50 .. 40.90, cell size 0.01 degree,
# time axis = day of month 1 .. 31.
DEFAULT_X_RANGE = (-74.50, -73.70)
DEFAULT_Y_RANGE = (40.50, 40.90)
DEFAULT_STEP = 0.01
DEFAULT_Z_RANGE = (1, 31)

# Fixed value: pickup time text format (24-hour clock).
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _cell_bound(coord: float, step: float) -> int:
    # Same double division as the cell assignment, so the extent's corners
    # land in the boundary cells.
    return math.floor(coord / step)


@dataclass(frozen=True)
class GridSpec:
    """Integer cell bounds of a space-time grid plus the cell size."""

    min_x: int
    max_x: int
    min_y: int
    max_y: int
    min_z: int = 1
    max_z: int = 31
    step_x: float = DEFAULT_STEP
    step_y: float = DEFAULT_STEP
    z_unit: str = DAY_OF_MONTH

    def __post_init__(self):
        if self.max_x < self.min_x or self.max_y < self.min_y or self.max_z < self.min_z:
            raise ValueError(f"empty grid: {self}")
        if self.step_x <= 0 or self.step_y <= 0:
            raise ValueError("cell steps must be positive")
        if self.z_unit not in (DAY_OF_MONTH, DAY_OF_YEAR):
            raise ValueError(f"unknown z unit {self.z_unit!r}")

    @classmethod
    def from_extent(
        cls,
        x_range: tuple[float, float],
        y_range: tuple[float, float],
        step_x: float = DEFAULT_STEP,
        step_y: float | None = None,
        z_range: tuple[int, int] = DEFAULT_Z_RANGE,
        z_unit: str = DAY_OF_MONTH,
    ) -> "GridSpec":
        """Grid covering a coordinate extent (in coordinate units)."""
        step_y = step_x if step_y is None else step_y
        return cls(
            min_x=_cell_bound(x_range[0], step_x),
            max_x=_cell_bound(x_range[1], step_x),
            min_y=_cell_bound(y_range[0], step_y),
            max_y=_cell_bound(y_range[1], step_y),
            min_z=z_range[0],
            max_z=z_range[1],
            step_x=step_x,
            step_y=step_y,
            z_unit=z_unit,
        )

    @classmethod
    def default(cls) -> "GridSpec":
        """The original study grid: 81 x 41 x 31 = 102951 cells."""
        return cls.from_extent(DEFAULT_X_RANGE, DEFAULT_Y_RANGE, DEFAULT_STEP, DEFAULT_STEP, DEFAULT_Z_RANGE)

    @property
    def width(self) -> int:
        return self.max_x - self.min_x + 1

    @property
    def height(self) -> int:
        return self.max_y - self.min_y + 1

    @property
    def depth(self) -> int:
        return self.max_z - self.min_z + 1

    @property
    def layer(self) -> int:
        return self.width * self.height

    @property
    def num_cells(self) -> int:
        return self.layer * self.depth


# ---------------------------------------------------------------- assignment


def cell_coord(coord, step: float) -> Column:
    """``floor(coord / step)`` with a DOUBLE step; result is bigint.

    NaN lies in no cell: the result is NULL, as for a NULL coordinate.
    """
    c = as_col(coord)
    return F.when(~F.isnan(c), F.floor(c / F.lit(float(step))))


def cell_x(px, spec: GridSpec) -> Column:
    return cell_coord(px, spec.step_x)


def cell_y(py, spec: GridSpec) -> Column:
    return cell_coord(py, spec.step_y)


def parse_time(text, mode: str = "strict", fmt: str = TIME_FORMAT) -> Column:
    """Pickup time text -> ``timestamp_ntz`` (no session time zone involved).

    strict: malformed or NULL text fails the job, in ANSI mode or not;
    permissive: NULL.
    """
    if mode == "strict":
        t = as_col(text)
        malformed = F.raise_error(F.concat(F.lit("malformed time: "), t))
        parsed = F.coalesce(F.to_timestamp_ntz(t, F.lit(fmt)), malformed)
        return F.when(t.isNotNull(), parsed).otherwise(F.raise_error(F.lit("NULL time text")))
    # try_to_timestamp reads wall-clock time in the session zone; casting
    # back to NTZ returns the same wall clock, so the day is unchanged.
    return F.try_to_timestamp(as_col(text), F.lit(fmt)).cast("timestamp_ntz")


def day_of_month(ts) -> Column:
    return F.dayofmonth(as_col(ts))


def day_of_year(ts) -> Column:
    return F.dayofyear(as_col(ts))


def cell_z(ts, spec: GridSpec) -> Column:
    return day_of_year(ts) if spec.z_unit == DAY_OF_YEAR else day_of_month(ts)


def in_grid(x, y, z, spec: GridSpec) -> Column:
    """Cell lies inside the grid box (closed bounds)."""
    return (
        as_col(x).between(spec.min_x, spec.max_x)
        & as_col(y).between(spec.min_y, spec.max_y)
        & as_col(z).between(spec.min_z, spec.max_z)
    )


def grid_point_filter(px, py, spec: GridSpec) -> Column:
    """Literal range on the raw coordinates that keeps every in-grid point.

    One cell of margin on each side absorbs the rounding of ``px / step``;
    the exact test is :func:`in_grid` on the cells.  Being a comparison of
    a source column with literals, it reaches a parquet scan as a pushed
    filter.
    """
    return as_col(px).between(
        F.lit((spec.min_x - 1) * spec.step_x), F.lit((spec.max_x + 2) * spec.step_x)
    ) & as_col(py).between(F.lit((spec.min_y - 1) * spec.step_y), F.lit((spec.max_y + 2) * spec.step_y))


# ---------------------------------------------------------------- cell ids


def cell_id(x, y, z, spec: GridSpec) -> Column:
    """1-based linear id; meaningful only for in-grid cells."""
    return (
        (as_col(z).cast("bigint") - spec.min_z) * spec.layer
        + (F.lit(spec.max_y) - as_col(y)) * spec.width
        + (as_col(x) - spec.min_x + 1)
    ).cast("bigint")


def _idiv(a: Column, b: int) -> Column:
    """Exact integer division (SQL ``div``), bigint result."""
    return F.call_function("div", a, F.lit(b))


def cell_of_id(cell, spec: GridSpec) -> Column:
    """Inverse of :func:`cell_id` -> ``struct<x: bigint, y: bigint, z: int>``."""
    k = as_col(cell).cast("bigint") - 1
    r = k % spec.layer
    return F.struct(
        (F.lit(spec.min_x) + r % spec.width).cast("bigint").alias("x"),
        (F.lit(spec.max_y) - _idiv(r, spec.width)).cast("bigint").alias("y"),
        (_idiv(k, spec.layer) + spec.min_z).cast("int").alias("z"),
    )


# ---------------------------------------------------------------- adjacency


def is_adjacent(ax, ay, az, bx, by, bz, spec: GridSpec) -> Column:
    """Both cells in the grid and no axis differs by more than 1.

    A cell is adjacent to itself; there is no wrap-around on any axis.
    """
    return (
        in_grid(ax, ay, az, spec)
        & in_grid(bx, by, bz, spec)
        & (F.abs(as_col(ax) - as_col(bx)) <= 1)
        & (F.abs(as_col(ay) - as_col(by)) <= 1)
        & (F.abs(as_col(az) - as_col(bz)) <= 1)
    )


def _axis_slots(c: Column, lo: int, hi: int) -> Column:
    # Slots on one axis inside [lo, hi] around c (3 inside, 2 on an edge,
    # 1 when lo == hi).
    return F.least(c + 1, F.lit(hi)) - F.greatest(c - 1, F.lit(lo)) + 1


def neighbor_weight(x, y, z, spec: GridSpec) -> Column:
    """Number of 3x3x3 neighbourhood slots (self included) inside the grid.

    Empty cells count: the Gi* weights are 1 for every in-grid neighbour,
    populated or not.  Closed form, no join.
    """
    return (
        _axis_slots(as_col(x), spec.min_x, spec.max_x)
        * _axis_slots(as_col(y), spec.min_y, spec.max_y)
        * _axis_slots(as_col(z), spec.min_z, spec.max_z)
    ).cast("bigint")


# Neighbourhood slots 0..26: slot k is the offset
# (k % 3 - 1, (k div 3) % 3 - 1, k div 9 - 1); slot 13 is the cell itself.
NUM_SLOTS = 27
SELF_SLOT = 13


def neighbor_slots() -> Column:
    """``array<int>`` 0..26, one entry per 3x3x3 neighbourhood slot."""
    return F.sequence(F.lit(0), F.lit(NUM_SLOTS - 1))


def slot_offset(slot, axis: int) -> Column:
    """Offset (-1, 0, 1) of a neighbourhood slot along axis 0 (x), 1 (y) or 2 (z)."""
    k = as_col(slot)
    if axis == 0:
        return k % 3 - 1
    if axis == 1:
        return _idiv(k, 3) % 3 - 1
    return _idiv(k, 9) - 1
