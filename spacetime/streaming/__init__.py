"""Structured Streaming versions of the zone count and the hot-cell ranking."""

from spacetime.streaming.hotspots import (
    cell_counts_stream,
    read_parquet_stream,
    read_points_stream,
    run_to_table,
    start_hot_cells,
    start_zone_counts,
    stream_location,
    zone_counts_stream,
)

__all__ = [
    "cell_counts_stream", "read_parquet_stream", "read_points_stream", "run_to_table", "start_hot_cells",
    "start_zone_counts", "stream_location", "zone_counts_stream",
]
