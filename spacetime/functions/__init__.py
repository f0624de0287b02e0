"""Column expressions: point/rectangle text, containment, grid cells.

SQL users: :func:`spacetime.functions.sql.register_sql_functions`.
"""

from spacetime.functions.geometry import (
    contains,
    contains_text,
    parse_point,
    parse_rectangle,
    point_text,
    rectangle_text,
    strip_parens,
)
from spacetime.functions.grid import (
    GridSpec,
    cell_id,
    cell_of_id,
    cell_x,
    cell_y,
    cell_z,
    day_of_month,
    day_of_year,
    in_grid,
    is_adjacent,
    neighbor_slots,
    slot_offset,
    neighbor_weight,
    parse_time,
)

__all__ = [
    "GridSpec", "cell_id", "cell_of_id", "cell_x", "cell_y", "cell_z", "contains", "contains_text",
    "day_of_month", "day_of_year", "in_grid", "is_adjacent", "neighbor_slots", "neighbor_weight",
    "parse_point", "parse_rectangle", "parse_time", "point_text", "rectangle_text", "slot_offset", "strip_parens",
]
