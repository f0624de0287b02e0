"""3x3x3 neighbourhoods on the grid, set-at-a-time.

Every populated in-grid cell *scatters* its count to the 27 cells of its
neighbourhood (itself included); one aggregation then gathers, per target
cell, the neighbourhood sum.  The self slot also tells whether the target is
populated, so no join back to the counts is needed.

The shuffle carries at most ``27 x #populated cells`` rows, independent of
the number of points, and every target receives at most 27 rows: there is
no hot key at this stage.  Co-locating cells by spatial block first
(:func:`colocate_blocks`) lets the map-side partial sum combine most of the
27 contributions before they are shuffled (about 1.4 rows per cell).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spacetime.functions.grid import SELF_SLOT, GridSpec, in_grid, neighbor_slots, neighbor_weight, slot_offset


def _scatter(counts: DataFrame, spec: GridSpec) -> DataFrame:
    """(target cell, contributed count, is_self) for every in-grid slot.

    Source cells are never *filtered*: a filter on them would be pushed
    below the count aggregation and make this branch's ``counts`` differ
    from the one the grid totals read (those include off-grid cells), so
    the points would be scanned and aggregated twice.  Instead, cells more
    than one step outside the grid get a NULL offset array (explode emits
    nothing; the test lives inside the generator, where Catalyst cannot
    push it), and the off-grid ring around the grid contributes NULL counts.
    Both branches then share one counts exchange.
    """
    near = in_grid(
        "x", "y", "z",
        GridSpec(spec.min_x - 1, spec.max_x + 1, spec.min_y - 1, spec.max_y + 1, spec.min_z - 1, spec.max_z + 1),
    )
    src = counts.select(
        "x",
        "y",
        "z",
        F.when(in_grid("x", "y", "z", spec), F.col("n")).alias("n"),
        F.explode(F.when(near, neighbor_slots())).alias("k"),
    )
    return src.select(
        (F.col("x") + slot_offset("k", 0)).alias("x"),
        (F.col("y") + slot_offset("k", 1)).alias("y"),
        (F.col("z") + slot_offset("k", 2)).cast("int").alias("z"),
        F.col("n"),
        (F.col("k") == SELF_SLOT).alias("is_self"),
    ).filter(in_grid("x", "y", "z", spec))


# Cells per block side when co-locating neighbours before the scatter.
DEFAULT_BLOCK = 16


def colocate_blocks(counts: DataFrame, block: int, partitions: int | None = None) -> DataFrame:
    """Hash-partition cells by their ``block^3`` spatial block.

    Neighbouring cells then sit in the same task, so the map-side partial
    sum of the scatter combines the 27 contributions to a target before the
    shuffle: the scatter shuffle carries about ``(block+2)^3 / block^3`` rows
    per populated cell (1.4 for 16) instead of 27.  The exchange itself moves
    one row per populated cell, and a block holds at most ``block^3`` cells,
    so no partition can become hot.  ``partitions`` raises the number of
    partitions above ``spark.sql.shuffle.partitions``.
    """
    b = F.lit(float(block))
    # An explicit partition count: AQE would size these partitions by their
    # (small) input bytes and may merge them into a few tasks, but each row
    # fans out 27-fold right after.  The count follows the session's shuffle
    # partitions, never the cores that happen to be there while planning.
    parts = max(partitions or 1, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return counts.repartition(parts, F.floor(F.col("x") / b), F.floor(F.col("y") / b), F.floor(F.col("z") / b))


def neighbor_sums(counts: DataFrame, spec: GridSpec, block: int | None = DEFAULT_BLOCK,
                  partitions: int | None = None) -> DataFrame:
    """Per populated in-grid cell: ``x, y, z, n, sum1, w``.

    ``sum1`` = counts of the cell and its populated in-grid neighbours,
    ``w``    = in-grid neighbourhood slots, populated or not (closed form).
    ``block`` co-locates neighbours first, in ``partitions`` (see
    :func:`colocate_blocks`); ``None`` scatters straight from the counts.
    """
    if block:
        counts = colocate_blocks(counts, block, partitions)
    gathered = (
        _scatter(counts, spec)
        .groupBy("x", "y", "z")
        .agg(
            F.sum(F.when(F.col("is_self"), F.col("n"))).alias("n"),
            F.sum("n").alias("sum1"),
        )
        .filter(F.col("n").isNotNull())
    )
    return gathered.withColumn("w", neighbor_weight("x", "y", "z", spec))


#: Cells per block side of :func:`box_sums` on x and y, and on z.
BOX_BLOCK, BOX_DEPTH = 32, 64


def halo_blocks(counts: DataFrame, block: int = BOX_BLOCK, depth: int = BOX_DEPTH) -> DataFrame:
    """Every cell in its block ``bx, by, bz``, and those at a block's edge once
    more in each block beyond it: what a block needs to sum its own cells alone."""
    out = counts
    for c, side in (("x", block), ("y", block), ("z", depth)):
        b = F.call_function("div", F.col(c) - F.pmod(F.col(c), F.lit(side)), F.lit(side))
        place = F.pmod(F.col(c), F.lit(side))
        before = F.when(place == 0, F.array(b - 1)).otherwise(F.array().cast("array<bigint>"))
        behind = F.when(place == side - 1, F.array(b + 1)).otherwise(F.array().cast("array<bigint>"))
        out = out.select("*", F.explode(F.concat(F.array(b), before, behind)).alias(f"b{c}"))
    return out


def box_sums(counts: DataFrame, spec: GridSpec, block: int = BOX_BLOCK, depth: int = BOX_DEPTH, partitions: int | None = None) -> DataFrame:
    """The rows of :func:`neighbor_sums` by sums along one axis after the other.

    Cells are shuffled once, to their block and as a halo to the blocks they
    border on (about ``(block + 2)^2 / block^2`` rows a cell).  In a block the
    sums over x - 1 .. x + 1, then over y - 1 .. y + 1 of those, are made for
    every cell that needs them, and a window along z sums the last three: three
    times three terms a cell in place of 27, and no second shuffle.
    """
    if block < 2 or depth < 2:
        raise ValueError("a block needs a side of at least 2")
    parts = max(partitions or 1, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = counts.where(in_grid("x", "y", "z", spec)).select("x", "y", F.col("z").cast("bigint").alias("z"), "n")
    dealt = halo_blocks(cells, block, depth).repartition(parts, "bx", "by", "bz")
    # n: the cell's own count (null between the populated ones), s: the sum so far
    part = dealt.withColumn("s", F.col("n"))
    for c in ("x", "y"):
        to = F.explode(F.sequence(F.greatest(F.col(c) - 1, F.col(f"b{c}") * block), F.least(F.col(c) + 1, F.col(f"b{c}") * block + block - 1))).alias("to")
        # a halo cell has one neighbour in the block; a sequence must not run backwards
        reach = part.where(F.col(c).between(F.col(f"b{c}") * block - 1, F.col(f"b{c}") * block + block)).select("*", to)
        here = {"x": "x", "y": "y", "z": "z", c: "to"}
        key = ["bx", "by", "bz", *[F.col(here[a]).alias(a) for a in "xyz"]]
        part = reach.groupBy(*key).agg(F.max(F.when(F.col("to") == F.col(c), F.col("n"))).alias("n"), F.sum("s").alias("s"))
    along = Window.partitionBy("bx", "by", "bz", "x", "y").orderBy("z").rangeBetween(-1, 1)
    own = F.col("n").isNotNull() & (F.col("bz") == F.call_function("div", F.col("z") - F.pmod(F.col("z"), F.lit(depth)), F.lit(depth)))
    done = part.withColumn("sum1", F.sum("s").over(along)).where(own)
    return done.select("x", "y", F.col("z").cast("int").alias("z"), "n", "sum1").withColumn("w", neighbor_weight("x", "y", "z", spec))


def adjacent_cell_pairs(cells: DataFrame, spec: GridSpec) -> DataFrame:
    """Pairs of populated in-grid cells that are adjacent (self pairs included).

    ``cells`` holds distinct ``x, y, z``.  Each cell proposes its 27
    neighbour slots, which are equi-joined to the populated cells, so the
    result is bounded by 27 x #cells and no theta join is planned.
    """
    cells = cells.select("x", "y", "z").filter(in_grid("x", "y", "z", spec))
    slots = cells.select("x", "y", "z", F.explode(neighbor_slots()).alias("k")).select(
        "x",
        "y",
        "z",
        (F.col("x") + slot_offset("k", 0)).alias("nx"),
        (F.col("y") + slot_offset("k", 1)).alias("ny"),
        (F.col("z") + slot_offset("k", 2)).cast("int").alias("nz"),
    )
    other = cells.select(F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("z").alias("nz"))
    return slots.join(other, on=["nx", "ny", "nz"], how="inner").select("x", "y", "z", "nx", "ny", "nz")
