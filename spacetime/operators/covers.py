"""Points per rectangle from counts: zones as covers of hierarchical cells.

Space is cut into the cells of a quadtree.  A point has one key, its cell at the
deepest level in use (the interleaved bits of its column and row); the cells it
lies in at every coarser level are prefixes of that key.  A zone becomes two sets
of cells:

* *inside* cells, in which every point matches: the largest cells of any level
  that lie between the zone's edges.  They never meet a point.  The points are
  counted per cell first, the counts are added up level by level, and an inside
  cell joins one count;
* *border* cells of the deepest level, which the zone's edges run through.  Only
  the points of these are compared with the zone.

So a zone that holds nearly all points costs a few joined counts, an edge at
infinity needs no border at all, and zones of any mixture of sizes need one key
a point.  The number of cells of a zone grows with its edges at the deepest
level, which is chosen so that the border table stays within ``cells_per_zone``
rows a zone and ``spare_cells`` more.

A small border table is broadcast and the points are not shuffled.  Otherwise the
points are shuffled once, and both the counts and the border join read that
shuffle.  Its key is (slot, cell).  Slots are ranges of the interleaved key at
full depth that hold equally many points of a sample: each split halves space
across one axis in turn, where the points are.  A cell with many points lies in
many slots, and where equal keys fill more than one slot their points are dealt
by a hash over the parts they fill, so no key holds more than a small part of a
partition.

Cells are compared, never recomputed: a point right of a zone's left edge cannot
lie in a cell left of that edge's cell, as the cell of a coordinate never falls
when the coordinate grows.  Strictly between the cells of two edges everything
matches, whatever rounding did.
"""

from __future__ import annotations

import bisect
import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spacetime.functions.curve import interleaved
from spacetime.functions.geometry import contains

#: Levels of the quadtree used by slots; an index per axis has so many bits.
DEPTH = 26
#: The deepest level whose cells are counted and joined.
MAX_LEVEL = 12
#: What a plan says if it has no estimate is near the largest long.
UNKNOWN_SIZE = 1 << 60
ZONE_AXES = (("x1", "x2"), ("y1", "y2"))
EDGES = ["rectangle", *(c for axis in ZONE_AXES for c in axis)]


# ------------------------------------------------------------------ cells


class Frame:
    """Where cells lie: the box that holds all finite edges, per axis its lower
    end and the width of a cell at full depth.  Beyond it the outermost cells
    go on for ever."""

    def __init__(self, low: tuple[float, float], high: tuple[float, float]):
        self.low = low
        self.step = tuple((h - a) / 2**DEPTH if 0 < (h - a) / 2**DEPTH < math.inf else 1.0 for a, h in zip(low, high))

    def index(self, axis: int, value: Column) -> Column:
        """A coordinate's row or column of cells at full depth."""
        place = (value - F.lit(self.low[axis])) / F.lit(self.step[axis])
        return F.floor(F.least(F.lit(float(2**DEPTH - 1)), F.greatest(F.lit(0.0), place)))


def cell_at(key: Column, level: Column) -> Column:
    """A name for the cell with ``key`` at ``level``, unlike that of any cell of
    another level."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (2 * level).cast("int")).bitwiseOR(key)


def never_null(df: DataFrame, c: str) -> DataFrame:
    """``df`` with its column ``c``, which has no nulls, said to have none: else a
    join on it would have its rows filtered for nulls at the scan, with the whole
    computation of the key written out in that filter."""
    return df.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("bigint")))


def point_keys(points: DataFrame, frame: Frame, px: str, py: str) -> DataFrame:
    """``points`` with ``_key``, the interleaved key at full depth."""
    return never_null(interleaved(points, frame.index(0, F.col(px)), frame.index(1, F.col(py)), "_key"), "_key")


# ------------------------------------------------------------------ zones


def zone_spans(zones: DataFrame, frame: Frame) -> DataFrame:
    """Valid zones with the cells of their edges at full depth, ``_a0.._b1``, and
    whether an edge is open, ``_oa0.._ob1``."""
    out = {}
    for i, (lo, hi) in enumerate(ZONE_AXES):
        out |= {f"_a{i}": frame.index(i, F.col(lo)), f"_b{i}": frame.index(i, F.col(hi))}
        out |= {f"_oa{i}": F.col(lo) == -math.inf, f"_ob{i}": F.col(hi) == math.inf}
    return zones.withColumns(out)


def _column(level: Column | int) -> Column:
    return F.lit(level) if isinstance(level, int) else level


def touched(axis: int, level: Column | int) -> tuple[Column, Column]:
    """First and last index a zone touches on an axis at a level."""
    shift = F.lit(DEPTH) - _column(level)
    return tuple(F.call_function("shiftright", F.col(f"_{e}{axis}"), shift.cast("int")) for e in "ab")


def between(axis: int, level: Column | int) -> tuple[Column, Column]:
    """First and last index strictly between a zone's edges (first > last: none)."""
    a, b = touched(axis, level)
    last = F.call_function("shiftleft", F.lit(1).cast("bigint"), _column(level).cast("int")) - 1
    return F.when(F.col(f"_oa{axis}"), F.lit(0).cast("bigint")).otherwise(a + 1), F.when(F.col(f"_ob{axis}"), last).otherwise(b - 1)


def _length(first: Column, last: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), last - first + 1).cast("double")


def border_cells(level: Column | int) -> Column:
    """Cells of ``level`` that a zone touches and does not hold."""
    full = [_length(*touched(i, level)) for i in (0, 1)]
    inner = [_length(*between(i, level)) for i in (0, 1)]
    return full[0] * full[1] - inner[0] * inner[1]


def deepest_level(spans: DataFrame, room: float, max_level: int) -> tuple[int, int]:
    """The deepest level at which all zones' border cells have ``room``, and
    their number there: one aggregate, with a row for each level."""
    levels = spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_level))).alias("_level"))
    rows = levels.groupBy("_level").agg(F.sum(border_cells(F.col("_level"))).alias("n")).collect()
    sizes = {r["_level"]: r["n"] for r in rows}
    level = max((k for k, n in sizes.items() if n <= room), default=0 if sizes else max_level)
    return level, int(sizes.get(level, 0))


def _range(first: Column, last: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(first <= last, F.sequence(first, last)).otherwise(none)


def border_of(spans: DataFrame, level: int, columns: list[str]) -> DataFrame:
    """``columns`` with ``_cell``: each zone once per border cell."""
    (a0, b0), (a1, b1) = (touched(i, level) for i in (0, 1))
    (i0, j0), (i1, j1) = (between(i, level) for i in (0, 1))
    wide = spans.select("*", a1.alias("_y0"), b1.alias("_y1"), i0.alias("_i0"), j0.alias("_j0"), i1.alias("_i1"), j1.alias("_j1"), F.explode(_range(a0, b0)).alias("_x"))
    # in a column between the edges, all rows but those between the edges; otherwise all rows
    part = (F.col("_x").between(F.col("_i0"), F.col("_j0"))) & (F.col("_i1") <= F.col("_j1"))
    rows = F.when(part, F.concat(_range(F.col("_y0"), F.col("_i1") - 1), _range(F.col("_j1") + 1, F.col("_y1")))).otherwise(_range(F.col("_y0"), F.col("_y1")))
    cells = interleaved(wide.select(*columns, "_x", F.explode(rows).alias("_y")), F.col("_x"), F.col("_y"), "_cell")
    return never_null(cells.drop("_x", "_y"), "_cell")


def inside_of(spans: DataFrame, level: int, columns: list[str]) -> DataFrame:
    """``columns`` with ``_name`` (see :func:`cell_at`): the largest cells, down to
    ``level``, that lie between each zone's edges.

    The cells between the edges at one level, less those whose parent is too,
    are a frame of one cell's width."""
    at = spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(level))).alias("_level"))
    lv = F.col("_level")
    for i in (0, 1):
        first, last = between(i, lv)
        up, down = between(i, F.greatest(lv - 1, F.lit(0)))
        at = at.withColumns({f"_f{i}": first, f"_l{i}": last, f"_p{i}": 2 * up, f"_q{i}": 2 * down + 1})
    at = at.where("_f0 <= _l0 AND _f1 <= _l1")
    whole = (F.col("_level") == 0) | (F.col("_p0") > F.col("_q0")) | (F.col("_p1") > F.col("_q1"))
    wide = at.withColumn("_whole", whole).select(*columns, "_level", "_whole", "_p0", "_q0", "_f1", "_l1", "_p1", "_q1", F.explode(_range(F.col("_f0"), F.col("_l0"))).alias("_x"))
    part = ~F.col("_whole") & F.col("_x").between(F.col("_p0"), F.col("_q0"))
    rows = F.when(part, F.concat(_range(F.col("_f1"), F.col("_p1") - 1), _range(F.col("_q1") + 1, F.col("_l1")))).otherwise(_range(F.col("_f1"), F.col("_l1")))
    cells = wide.select(*columns, "_level", "_x", F.explode(rows).alias("_y"))
    return never_null(interleaved(cells, F.col("_x"), F.col("_y"), "_k").select(*columns, cell_at(F.col("_k"), lv).alias("_name")), "_name")


def counts_of_levels(counts: DataFrame, level: int) -> DataFrame:
    """``_name, _n`` of every cell that holds points, at all levels, from
    ``_cell, _n`` at ``level``."""
    up = F.explode(F.sequence(F.lit(0), F.lit(level))).alias("_level")
    at = counts.select("_cell", "_n", up)
    key = F.call_function("shiftright", F.col("_cell"), (2 * (F.lit(level) - F.col("_level"))).cast("int"))
    return at.groupBy(cell_at(key, F.col("_level")).alias("_name")).agg(F.sum("_n").alias("_n"))


# ------------------------------------------------------------------ slots


class Slots:
    """Ranges of keys with equally many sampled points, and into how many parts
    a range of equal keys is dealt."""

    def __init__(self, quantiles: list[float]):
        cuts = sorted(quantiles)
        self.starts = sorted(set(cuts))
        # a key that fills several quantiles is a slot of its own with as many parts
        self.full = {c: cuts.count(c) for c in self.starts if cuts.count(c) > 1}
        edges = sorted({*self.starts, *(c + 1 for c in self.full)})
        self.edges = [-math.inf, *edges, math.inf]
        self.parts = [1] + [self.full.get(c, 1) for c in edges]

    def find(self, df: DataFrame, key: str, out: str) -> DataFrame:
        """``df`` with the slot of ``key``, by binary search in the JVM."""
        if len(self.edges) < 3:
            return df.withColumn(out, F.lit(0))
        found = Bucketizer(splits=self.edges, inputCol="_search", outputCol="_found").transform(df.withColumn("_search", F.col(key).cast("double")))
        return found.withColumn(out, F.col("_found").cast("int")).drop("_search", "_found")

    def place(self, key: int) -> int:
        return bisect.bisect_right(self.edges, key) - 1

    def parts_of(self, slot: str) -> Column:
        out = F.lit(1)
        for i, n in enumerate(self.parts):
            if n > 1:
                out = F.when(F.col(slot) == i, F.lit(n)).otherwise(out)
        return out


def slots_of(keyed: DataFrame, n_slots: int, sample_rows: int) -> Slots:
    """Slots from a sample of about ``sample_rows`` points, by one pass over
    their coordinates; how many points there are is taken from the plan's size,
    or counted where the plan does not know.  Only cut points come to the driver."""
    keys = keyed.select(F.col("_key").cast("double").alias("k"))
    size = int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = size // 16 if size < UNKNOWN_SIZE else keys.count()
    fraction = sample_rows / max(1, rows)
    if fraction < 1:
        keys = keys.sample(fraction=fraction, seed=7)
    probabilities = [i / n_slots for i in range(1, n_slots)]
    return Slots(keys.approxQuantile("k", probabilities, 0.1 / n_slots) if probabilities else [])


def dealt_points(keyed: DataFrame, slots: Slots, level: int, partitions: int, px: str, py: str) -> DataFrame:
    """``px, py, _slot, _part, _cell``, shuffled by slot, part and cell."""
    with_slot = slots.find(keyed.select(px, py, "_key"), "_key", "_slot")
    # equal points of one input partition share a part, those of others need not
    h = F.xxhash64(px, py, F.spark_partition_id())
    cell = F.shiftright("_key", 2 * (DEPTH - level))
    out = with_slot.select(px, py, "_slot", F.pmod(h, slots.parts_of("_slot")).cast("int").alias("_part"), cell.alias("_cell"))
    # said here, the join need not add it to its branch only
    known = F.col("_slot").isNotNull() & F.col("_part").isNotNull() & F.col("_cell").isNotNull()
    return out.where(known).repartition(partitions, "_slot", "_part", "_cell")


def dealt_zones(border: DataFrame, slots: Slots, level: int) -> DataFrame:
    """Border rows once for every slot and part that holds points of their cell."""
    shift = 2 * (DEPTH - level)
    ends = border.withColumns({"_lo": F.shiftleft("_cell", shift), "_hi": F.shiftleft(F.col("_cell") + 1, shift) - 1})
    ends = slots.find(slots.find(ends, "_lo", "_s0"), "_hi", "_s1")
    each = ends.withColumn("_slot", F.explode(F.sequence("_s0", "_s1"))).drop("_lo", "_hi", "_s0", "_s1")
    return each.withColumn("_part", F.explode(F.sequence(F.lit(0), slots.parts_of("_slot") - 1)))


# ------------------------------------------------------------------ counts


def cover_counts(
    points: DataFrame,
    zones: DataFrame,
    frame: Frame,
    n_zones: int,
    zone_bytes: float,
    *,
    px: str = "px",
    py: str = "py",
    max_level: int = MAX_LEVEL,
    cells_per_zone: int = 32,
    spare_cells: int = 1 << 10,
    broadcast_max_bytes: int = 64 << 20,
    slots_per_partition: int = 16,
    sample_rows: int = 200_000,
    shuffle: bool | None = None,
) -> DataFrame:
    """``rectangle, value``: matched points per zone text, empty zones absent.

    ``zones`` are ``n_zones`` valid ones (corners in order, no NaN), of
    ``zone_bytes`` each on average.  ``shuffle`` forces (or forbids) the shuffle
    of the points; by itself it is done if the border table exceeds
    ``broadcast_max_bytes``.  Planning is one aggregate over the zones, and one
    pass over a sample of the points if they are shuffled.
    """
    if not 0 <= max_level <= DEPTH:
        raise ValueError(f"max_level must be 0 to {DEPTH}")
    spans = zone_spans(zones.select(*EDGES), frame)
    level, n_border = deepest_level(spans, float(cells_per_zone) * n_zones + spare_cells, max_level)
    border = border_of(spans, level, EDGES)
    keyed = point_keys(points.select(px, py), frame, px, py)
    match = contains("x1", "y1", "x2", "y2", px, py)
    if shuffle is None:
        shuffle = n_border * (zone_bytes + 16) > broadcast_max_bytes
    if shuffle:
        partitions = max(1, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        slots = slots_of(keyed, slots_per_partition * partitions, sample_rows)
        dealt = dealt_points(keyed, slots, level, partitions, px, py)
        # both branches read one exchange: the count reads the coordinates too, so that both need the same columns
        here = F.count_if(F.col(px).isNotNull() & F.col(py).isNotNull())
        counts = dealt.groupBy("_slot", "_part", "_cell").agg(here.alias("_n"))
        pairs = dealt.join(dealt_zones(border, slots, level).hint("shuffle_merge"), ["_slot", "_part", "_cell"]).where(match)
    else:
        celled = keyed.select(px, py, F.shiftright("_key", 2 * (DEPTH - level)).alias("_cell"))
        counts = celled.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
        pairs = celled.join(F.broadcast(border), "_cell").where(match)
    parts = pairs.groupBy("rectangle").agg(F.count(F.lit(1)).alias("_n"))
    return total_counts(counts.select("_cell", "_n"), parts, spans, level)


def total_counts(counts: DataFrame, parts: DataFrame, spans: DataFrame, level: int) -> DataFrame:
    """``rectangle, value``: the points ``_cell, _n`` of cells that zones hold,
    and the matches ``rectangle, _n`` of the points at their edges."""
    whole = counts_of_levels(counts, level).join(inside_of(spans, level, ["rectangle"]), "_name").groupBy("rectangle").agg(F.sum("_n").alias("_n"))
    both = whole.unionByName(parts).groupBy("rectangle").agg(F.sum("_n").alias("_n"))
    return both.select("rectangle", F.when(F.col("rectangle").isNull(), F.lit(0)).otherwise(F.col("_n")).cast("long").alias("value"))
