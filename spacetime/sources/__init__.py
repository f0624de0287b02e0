"""Sources and sinks: CSV point/rectangle files, reports, benchmark tables."""

from spacetime.sources.csv import read_points_csv, read_rectangles_csv, write_report

__all__ = ["read_points_csv", "read_rectangles_csv", "write_report"]
