"""DataFrame operators: zone range join and count, grid cells, Gi* hot cells."""

from spacetime.operators.cells import assign_cells, cell_counts, grid_totals
from spacetime.operators.gistar import gi_star, hot_cells, score_cells, top_cells
from spacetime.operators.neighbors import adjacent_cell_pairs, neighbor_sums
from spacetime.operators.zones import (
    count_per_zone,
    hot_zones,
    points_from_text,
    zone_point_pairs,
    zones_from_text,
)

__all__ = [
    "adjacent_cell_pairs", "assign_cells", "cell_counts", "count_per_zone", "gi_star", "grid_totals",
    "hot_cells", "hot_zones", "neighbor_sums", "points_from_text", "score_cells", "top_cells",
    "zone_point_pairs", "zones_from_text",
]
