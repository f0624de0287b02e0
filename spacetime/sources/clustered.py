"""Points or cell counts in files along an interleaved key, and reads of cell
ranges that skip the rest.

:func:`write_clustered` sorts rows by the key of their cell (ranges of keys to
files, sorted within each), so a file, a row group and a page hold a small patch
of the plane and say so in their statistics.  :func:`read_cells` turns a
rectangle of cells into a few ranges of keys; they reach the Parquet scan as a
pushed filter, which skips the files' row groups and pages that hold none of
them, and the cells' own columns then decide exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.functions.curve import interleaved, key_ranges
from spacetime.functions.grid import GridSpec, in_grid

#: Cells -2**30 .. 2**30 - 1 on each axis have a key of their own.
BITS = 31
KEY = "cell_key"
ROW_GROUP_BYTES = 16 << 20


def _biased(c: Column) -> Column:
    """An index from 0; cells beyond the ends share the outermost key."""
    return F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), c.cast("bigint") + (1 << (BITS - 1))))


def write_clustered(df: DataFrame, path: str, x: Column | str = "x", y: Column | str = "y", files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write ``df`` as Parquet along the key of its cells.

    ``x`` and ``y`` are columns, or expressions, of whole cell indexes; the key is
    kept as ``cell_key``.  Rows without a cell have no key and are kept too.
    ``files`` is the number of ranges (the session's shuffle partitions if not
    given); a range with one hot cell is one file, as its rows are alike."""
    if KEY in df.columns:
        raise ValueError(f"the rows have a column {KEY} already")
    cell = [F.col(c) if isinstance(c, str) else c for c in (x, y)]
    both = cell[0].isNotNull() & cell[1].isNotNull()
    keyed = interleaved(df, *[F.when(both, _biased(c)) for c in cell], KEY)
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(n, KEY).sortWithinPartitions(KEY)
    dealt.write.option("parquet.block.size", str(row_group_bytes)).parquet(path)


def in_key_ranges(ranges: list[tuple[int, int]], key: str = KEY) -> Column:
    return reduce(lambda a, b: a | b, [F.col(key).between(F.lit(lo), F.lit(hi)) for lo, hi in ranges], F.lit(False))


def read_cells(spark: SparkSession, path: str, x: tuple[int, int], y: tuple[int, int], cell: tuple[Column | str, Column | str] = ("x", "y"), max_ranges: int = 64) -> DataFrame:
    """The rows of a clustered table whose cell lies in columns ``x`` and rows
    ``y``, both ends included.  ``cell`` are the columns, or expressions, of
    the cell as it was written."""
    half = 1 << (BITS - 1)
    low, high = 0, (1 << BITS) - 1
    at = [tuple(min(high, max(low, v + half)) for v in axis) for axis in (x, y)]
    cols = [F.col(c) if isinstance(c, str) else c for c in cell]
    rows = spark.read.parquet(path).where(in_key_ranges(key_ranges(*at, BITS, max_ranges) if x[0] <= x[1] and y[0] <= y[1] else []))
    return rows.where(cols[0].between(*map(F.lit, x)) & cols[1].between(*map(F.lit, y))).drop(KEY)


def read_grid(spark: SparkSession, path: str, spec: GridSpec, max_ranges: int = 64) -> DataFrame:
    """The cells ``x, y, z`` of a clustered table that lie in a grid."""
    rows = read_cells(spark, path, (spec.min_x, spec.max_x), (spec.min_y, spec.max_y), max_ranges=max_ranges)
    return rows.where(in_grid("x", "y", "z", spec))
