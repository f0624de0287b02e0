"""The order in which cells follow each other along an interleaved key.

The key of a cell has the bits of its column and row in turn, so the cells of any
square of the quadtree are one range of keys, and near cells mostly have near
keys.  :func:`interleaved` makes keys in the JVM; :func:`key_ranges` says, for a
rectangle of cells, which few ranges of keys hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The shifts and masks that move the bits of a number apart by halves.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def interleaved(df: DataFrame, column: Column, row: Column, out: str) -> DataFrame:
    """``df`` with ``out``, the bits of a column and a row in turn: the key of a
    cell of any level.  Each step is a projection, so no expression is repeated."""
    df = df.withColumns({"_m0": column.cast("bigint"), "_m1": row.cast("bigint")})
    for shift, mask in SPREAD:
        df = df.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask)) for c in ("_m0", "_m1")})
    return df.withColumn(out, F.col("_m0").bitwiseOR(F.shiftleft("_m1", 1))).drop("_m0", "_m1")


def key_ranges(x: tuple[int, int], y: tuple[int, int], bits: int, max_ranges: int = 64) -> list[tuple[int, int]]:
    """At most about ``max_ranges`` ranges of keys, in order, that hold all cells
    of columns ``x`` and rows ``y`` (both ends included, ``bits`` bits each).

    Squares that the rectangle holds are whole ranges; those it cuts are halved
    on both axes as long as there is room, largest first, and then taken whole.
    So few ranges are a little wider than the rectangle, never narrower."""
    if x[0] > x[1] or y[0] > y[1]:
        return []
    done, cut = [], [(0, 0, bits)]  # a square: its column and row in units of its side, and the bits of its side
    while cut:
        if len(done) + 4 * len(cut) > max_ranges and cut[0][2] < bits:
            done += cut
            break
        nxt = []
        for cx, cy, side in cut:
            x0, y0 = cx << side, cy << side
            x1, y1 = x0 + (1 << side) - 1, y0 + (1 << side) - 1
            if x1 < x[0] or x0 > x[1] or y1 < y[0] or y0 > y[1]:
                continue
            if side == 0 or (x[0] <= x0 and x1 <= x[1] and y[0] <= y0 and y1 <= y[1]):
                done.append((cx, cy, side))
            else:
                nxt += [(2 * cx + i, 2 * cy + j, side - 1) for j in (0, 1) for i in (0, 1)]
        cut = [c for c in nxt if not (((c[0] + 1) << c[2]) <= x[0] or (c[0] << c[2]) > x[1] or ((c[1] + 1) << c[2]) <= y[0] or (c[1] << c[2]) > y[1])]
    ranges = sorted((_key(cx, cy) << (2 * side), ((_key(cx, cy) + 1) << (2 * side)) - 1) for cx, cy, side in done)
    out: list[tuple[int, int]] = []
    for lo, hi in ranges:
        if out and out[-1][1] + 1 == lo:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _key(column: int, row: int) -> int:
    return sum(((column >> i & 1) | (row >> i & 1) << 1) << (2 * i) for i in range(max(column.bit_length(), row.bit_length())))
