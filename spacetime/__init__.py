"""Space-time point analytics on Spark DataFrames.

Two analyses, each one lazy DataFrame plan:

* :func:`spacetime.operators.hot_zones` -- points per rectangle (range join + count).
* :func:`spacetime.operators.hot_cells` -- Getis-Ord Gi* hot cells of a space-time grid.
"""

from spacetime.functions.grid import GridSpec
from spacetime.operators import hot_cells, hot_zones

__all__ = ["GridSpec", "hot_cells", "hot_zones"]
