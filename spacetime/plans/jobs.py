"""Named analyses over CSV files, run as a batch of report writes.

``run_batch(spark, prefix, [("hotzoneanalysis", [points, rectangles]),
("hotcellanalysis", [points])])`` runs the queries in order and writes the
k-th result (k from 0) as header-less CSV to ``prefix + str(k)``.  Names are
case-insensitive; a wrong number of paths or an unknown name raises before
anything of that query runs (earlier queries stay written).

Each query is one lazy plan and the CSV write runs it; the zone query also
runs a planning action over the rectangle file (zone statistics for the join).
The layout of a report does not depend on its size: part files in the report's
order, or one file if the caller asks for it.

With ``shared_scan`` neighbouring queries of different kinds over one point file
read it once: their counts are taken in one pass (see
:mod:`spacetime.operators.onepass`), and both reports are finished from the
counts.  The reports are the same; a malformed point or time then fails both.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from spacetime.functions.geometry import STRICT
from spacetime.functions.grid import GridSpec
from spacetime.operators.gistar import hot_cells, score_cells, top_cells
from spacetime.operators.onepass import OnePass
from spacetime.operators.zones import hot_zones, points_from_text, zones_from_text
from spacetime.session import written as written_once
from spacetime.sources.csv import read_points_csv, read_rectangles_csv, write_report

# Fixed value: rows kept from the hot-cell ranking in a report.
HOT_CELL_REPORT_ROWS = 50


def hot_zone_analysis(spark: SparkSession, point_path: str, rectangle_path: str, mode: str = STRICT,
                      **join_options) -> DataFrame:
    """Point file x rectangle file -> ``rectangle, value`` sorted by text."""
    points = points_from_text(read_points_csv(spark, point_path), "point", mode)
    zones = zones_from_text(read_rectangles_csv(spark, rectangle_path), "rectangle", mode)
    return hot_zones(points, zones, **join_options)


def hot_cell_analysis(spark: SparkSession, point_path: str, spec: GridSpec | None = None,
                      k: int = HOT_CELL_REPORT_ROWS, mode: str = STRICT, clip: bool = False) -> DataFrame:
    """Point file -> the k hottest grid cells ``x, y, z`` (doubles)."""
    spec = spec or GridSpec.default()
    raw = read_points_csv(spark, point_path)
    pts = points_from_text(raw, "point", mode, time_col="pickup_time")
    return hot_cells(pts, spec, k=k, clip=clip)


def shared_counts(spark: SparkSession, point_path: str, rectangle_path: str, spec: GridSpec | None = None,
                  mode: str = STRICT, **options) -> OnePass:
    """One pass over a point file for both analyses."""
    points = points_from_text(read_points_csv(spark, point_path), "point", mode, time_col="pickup_time")
    zones = zones_from_text(read_rectangles_csv(spark, rectangle_path), "rectangle", mode)
    return OnePass(points, zones, spec or GridSpec.default(), **options)


def shared_analyses(spark: SparkSession, point_path: str, rectangle_path: str, spec: GridSpec | None = None,
                    k: int = HOT_CELL_REPORT_ROWS, mode: str = STRICT) -> dict[str, DataFrame]:
    """Both analyses of one point file, by query name.  The counts are written
    once to the shared folder; nothing reads the points again.  ``ValueError`` if
    the zones are too many for one pass."""
    spec = spec or GridSpec.default()
    one = shared_counts(spark, point_path, rectangle_path, spec, mode)
    counts = written_once(one.counts, "one-pass")
    return {"hotzoneanalysis": one.zone_counts(counts), "hotcellanalysis": top_cells(score_cells(one.cell_counts(counts), spec), k)}


@dataclass(frozen=True)
class _Query:
    arity: int
    run: Callable[..., DataFrame]


# The two query names of the batch interface.
QUERIES = {
    "hotzoneanalysis": _Query(2, hot_zone_analysis),
    "hotcellanalysis": _Query(1, hot_cell_analysis),
}


def _checked(name: str, params: Sequence[str]) -> _Query:
    q = QUERIES.get(name.lower())
    if q is None:
        raise KeyError(f"unknown query {name!r}; known: {sorted(QUERIES)}")
    if len(params) != q.arity:
        raise ValueError(f"query {name} needs {q.arity} path(s), got {len(params)}")
    return q


def run_query(spark: SparkSession, name: str, params: Sequence[str], output_path: str, single_file: bool = False) -> None:
    """Write one query's report.  By default it is written in parallel, the
    part files in the report's order; ``single_file`` sends all its rows through
    one task."""
    write_report(_checked(name, params).run(spark, *params), output_path, single_file=single_file)


def _share(queries: Sequence[tuple[str, Sequence[str]]], k: int) -> bool:
    """Queries ``k`` and ``k + 1`` are valid, of both kinds and of one point file."""
    if k + 1 >= len(queries):
        return False
    pair = [(name.lower(), list(params)) for name, params in queries[k : k + 2]]
    if any(name not in QUERIES or len(params) != QUERIES[name].arity for name, params in pair):
        return False
    return {name for name, _ in pair} == set(QUERIES) and pair[0][1][0] == pair[1][1][0]


def run_batch(spark: SparkSession, output_prefix: str, queries: Sequence[tuple[str, Sequence[str]]],
              single_file: bool = False, shared_scan: bool = False) -> list[str]:
    """Run the queries in order; return the output paths written.
    ``single_file`` holds for every report (see :func:`run_query`);
    ``shared_scan`` reads a point file once for two neighbouring queries."""
    written, at = [], 0
    while at < len(queries):
        found = None
        if shared_scan and _share(queries, at):
            rectangles = next(params[1] for name, params in queries[at : at + 2] if name.lower() == "hotzoneanalysis")
            try:
                found = shared_analyses(spark, queries[at][1][0], rectangles)
            except ValueError:  # too many zones for one pass: each query reads the file itself
                found = None
        for name, params in queries[at : at + (2 if found else 1)]:
            path = f"{output_prefix}{len(written)}"
            if found:
                write_report(found[name.lower()], path, single_file=single_file)
            else:
                run_query(spark, name, list(params), path, single_file)
            written.append(path)
        at += 2 if found else 1
    return written


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Expose DataFrames to SQL under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
