"""Points-in-rectangles: the range join and the per-zone count.

A point matches a zone when ``x1 <= px <= x2 and y1 <= py <= y2`` (closed
edges, corners not normalised; an edge may be infinite).  Three physical
strategies, all exact, all for any set of zones:

``nested_loop``
    ``points JOIN broadcast(zones) ON contains(..)``: a
    BroadcastNestedLoopJoin.  Per point it costs one test per zone, so AUTO
    uses it only for a zone set counted to have at most
    ``nested_loop_max_zones`` valid rows; asked for beyond that it refuses.

``tiled_broadcast``
    Space is cut into tiles.  Each zone is exploded into the tiles it covers;
    each point falls in exactly one tile; the equi-join on the tile key (a
    BroadcastHashJoin) is followed by the exact predicate.  The points are
    never shuffled.  Used when the zone-tile table, by its counted rows and
    measured row width, has at most ``broadcast_max_bytes``; asked for beyond
    that it refuses.

``tiled_shuffle``
    Same tile join, but both sides are shuffled on the tile key (sort-merge
    join).  Tiles that hold many points are found by counting points per tile;
    only their points are salted and only their zone tiles are replicated.

Tiles have a side per axis, so long thin zones do not share a few wide tiles.
Zones of very different sizes would make one side either explode big zones into
many tiles or put many points into few.  Sides therefore come in levels, per
axis: level ``l`` has side ``side * fanout**l``, and a zone uses on each axis
the lowest level at which it spans at most ``axis_tiles`` tiles; an axis on
which it is unbounded has one tile that holds everything.  No zone explodes
into more than about ``(axis_tiles + 1)^2`` tiles and none is capped or dropped.
A point carries one tile per combination of levels in use (usually one).  Each
(point, zone) pair meets in exactly one tile, so no duplicate matches arise.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spacetime.functions.geometry import (
    STRICT,
    check_mode,
    contains,
    nth_field,
    strip_parens,
    to_double,
)
from spacetime.functions.grid import TIME_FORMAT, parse_time
from spacetime.operators.covers import Frame, cover_counts

AUTO = "auto"
NESTED_LOOP = "nested_loop"
TILED_BROADCAST = "tiled_broadcast"
TILED_SHUFFLE = "tiled_shuffle"
#: Of counts only: see :mod:`spacetime.operators.covers`.
COVER = "cover"
STRATEGIES = (AUTO, NESTED_LOOP, TILED_BROADCAST, TILED_SHUFFLE)

ZONE_COLS = ("x1", "y1", "x2", "y2")
NESTED_LOOP_MAX_ZONES = 64
# Options of the cover, and those that no other strategy has.
COVER_ONLY = {"max_level", "cells_per_zone", "spare_cells", "slots_per_partition", "sample_rows", "shuffle"}
COVER_OPTIONS = COVER_ONLY | {"px", "py", "broadcast_max_bytes"}


# ------------------------------------------------------------------ inputs


def points_from_text(df: DataFrame, col: str = "point", mode: str = STRICT, keep=(), time_col: str | None = None,
                     time_format: str = TIME_FORMAT) -> DataFrame:
    """``"(x,y)"`` text column -> ``px, py`` doubles (+ ``t`` from ``time_col``).

    The parentheses are stripped once (a projection), and the numbers come
    out of a one-row ``inline`` generator.  Filters on ``px, py`` -- including the
    ``isnotnull`` that Catalyst infers from any later join or grid
    predicate -- stop at the generator instead of being pushed below it,
    where they would re-run the whole parse for every row.  Permissive
    mode drops rows whose point (or time) does not parse.
    """
    check_mode(mode)
    keep_cols = [F.col(k) if isinstance(k, str) else k for k in keep]
    stage = df.select(*keep_cols, strip_parens(col).alias("_text"),
                      *([F.col(time_col).alias("_time")] if time_col else []))
    kept = [c for c in stage.columns if c not in ("_text", "_time")]
    fields = [
        to_double(nth_field("_text", 0, mode), mode).alias("px"),
        to_double(nth_field("_text", 1, mode), mode).alias("py"),
    ]
    if time_col:
        fields.append(parse_time("_time", mode, time_format).alias("t"))
    out = stage.select(*kept, F.inline(F.array(F.struct(*fields))))
    if mode != STRICT:
        ok = F.col("px").isNotNull() & F.col("py").isNotNull()
        if time_col:
            ok = ok & F.col("t").isNotNull()
        out = out.filter(ok)
    return out


def zones_from_text(df: DataFrame, col: str = "rectangle", mode: str = STRICT) -> DataFrame:
    """``"x1,y1,x2,y2"`` text column -> ``rectangle`` text + four doubles.

    Same shape as :func:`points_from_text`: the numbers come from a one-row
    generator, so inferred filters do not re-run the parse.
    """
    check_mode(mode)
    stage = df.select(F.col(col).alias("rectangle"))
    fields = [to_double(nth_field("rectangle", i, mode), mode).alias(c) for i, c in enumerate(ZONE_COLS)]
    out = stage.select("rectangle", F.inline(F.array(F.struct(*fields))))
    if mode != STRICT:
        ok = F.col("x1").isNotNull()
        for c in ZONE_COLS[1:]:
            ok = ok & F.col(c).isNotNull()
        out = out.filter(ok)
    return out


# ------------------------------------------------------------------ helpers


def _contains(px: str, py: str):
    return contains("x1", "y1", "x2", "y2", px, py)


def _valid(zones: DataFrame) -> DataFrame:
    # Reversed corners (and NaN/NULL bounds) contain nothing: drop them
    # before tiling, ``sequence`` would otherwise count downwards.
    ok = (F.col("x1") <= F.col("x2")) & (F.col("y1") <= F.col("y2"))
    for c in ZONE_COLS:
        ok = ok & ~F.isnan(c)
    return zones.filter(ok)


AXES = (("x1", "x2"), ("y1", "y2"))
#: Level of an axis on which a zone is unbounded.
UNBOUNDED = -1
# Tile indexes stay below this, so that they are exact as doubles and longs.
MAX_INDEX = float(1 << 50)
# Most levels an axis can be given; planning computes how many it needs.
MAX_LEVELS = 24


def _extent(axis: int):
    lo, hi = AXES[axis]
    return F.col(hi) - F.col(lo)


def _bounded(axis: int):
    # the difference of two finite edges may still be infinite
    return F.abs(_extent(axis)) < F.lit(math.inf)


class Axis:
    """What the zones look like along one axis: typical and largest extent,
    and the tile side that follows from them."""

    def __init__(self, row, axis: int, n: int):
        self.max_extent = row[f"max{axis}"] or 0.0
        self.far = row[f"far{axis}"] or 0.0
        #: the lowest lower and the highest upper edge that are finite
        self.low, self.high = row[f"lo{axis}"], row[f"hi{axis}"]
        typical, positive = row[f"typ{axis}"], row[f"pos{axis}"] or 0
        spread = (row[f"hi{axis}"] or 0.0) - (row[f"lo{axis}"] or 0.0)
        density = spread / math.sqrt(n) if n and 0 < spread < math.inf else None
        if typical is None or not 0 < typical < math.inf:
            side = density
        elif 2 * positive < n and density is not None:
            side = min(typical, density)  # mostly point-like zones: by how densely they lie
        else:
            side = typical
        self.side = max(side or 1.0, self.far / MAX_INDEX)


class ZoneStats:
    """One one-row aggregate over the valid zones: count, bounding box, row
    width and, per axis, the extents that decide the tile side.

    The typical extent is the geometric mean of the positive extents,
    ``exp(avg(ln(extent)))``: it averages *scales*, so a few huge zones do
    not inflate it the way an arithmetic mean would, and unlike a
    percentile it stays a plain hash aggregate.
    """

    def __init__(self, zones: DataFrame):
        per_axis = []
        for i, (lo, hi) in enumerate(AXES):
            e = F.when(_bounded(i), _extent(i))
            per_axis += [
                F.exp(F.avg(F.when(e > 0, F.ln(e)))).alias(f"typ{i}"),
                F.count(F.when(e > 0, 1)).alias(f"pos{i}"),
                F.max(e).alias(f"max{i}"),
                F.min(F.when(F.abs(F.col(lo)) < math.inf, F.col(lo))).alias(f"lo{i}"),
                F.max(F.when(F.abs(F.col(hi)) < math.inf, F.col(hi))).alias(f"hi{i}"),
                F.max(F.when(e.isNotNull(), F.greatest(F.abs(F.col(lo)), F.abs(F.col(hi))))).alias(f"far{i}"),
            ]
        r = _valid(zones).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("x1").alias("x1"), F.min("y1").alias("y1"),
            F.max("x2").alias("x2"), F.max("y2").alias("y2"),
            F.avg(_row_bytes(zones)).alias("width"),
            *per_axis,
        ).first()
        self.n = int(r["n"])
        self.bbox = (r["x1"], r["y1"], r["x2"], r["y2"])
        self.row_bytes = float(r["width"] or 0.0)
        self.axes = tuple(Axis(r, i, self.n) for i in (0, 1))

    def point_filter(self, px: str, py: str):
        """Exact prefilter: a point outside the zones' bounding box matches none.

        Literal bounds on the raw point columns reach the parquet scan as
        pushed filters (row-group skipping on spatially clustered data).
        """
        if self.n == 0:
            return F.lit(False)
        x1, y1, x2, y2 = self.bbox
        return F.col(px).between(F.lit(x1), F.lit(x2)) & F.col(py).between(F.lit(y1), F.lit(y2))


def _row_bytes(zones: DataFrame):
    """Measured width of a zone row: 16 bytes a field, and what text, binary
    and nested values hold."""
    total = F.lit(16 * len(zones.columns))
    for field in zones.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return total


def auto_tile(zones: DataFrame) -> tuple[float, float]:
    """Base tile sides (x, y) that the zones' extents and density suggest."""
    return tuple(a.side for a in ZoneStats(zones).axes)


class TilePlan:
    """Tile sides per axis and level, shared by the zone and the point side.

    ``fanouts`` holds one fanout per axis; ``levels`` the (x, y) level pairs in
    use.
    """

    def __init__(self, sides, fanouts, axis_tiles: int, max_levels: int, levels=((0, 0),), n_tiles: int = 0):
        if any(s <= 0 or not math.isfinite(s) for s in sides):
            raise ValueError("tile must be a positive number")
        if any(f < 2 for f in fanouts) or axis_tiles < 1:
            raise ValueError("fanout must be >= 2 and axis_tiles >= 1")
        self.sides = tuple(map(float, sides))
        self.fanouts = tuple(map(int, fanouts))
        self.axis_tiles = int(axis_tiles)
        self.max_levels = int(max_levels)
        self.levels = sorted(tuple(p) for p in levels) or [(0, 0)]
        self.n_tiles = n_tiles

    def side(self, axis: int, level: int) -> float:
        return self.sides[axis] * float(self.fanouts[axis]) ** level

    def side_col(self, axis: int, level_col):
        # the same doubles as side(), looked up by level
        out = F.lit(self.sides[axis])
        for level in range(1, self.max_levels):
            s = self.side(axis, level)
            if not math.isfinite(s):
                break
            out = F.when(level_col == level, F.lit(s)).otherwise(out)
        return out

    def level_of(self, axis: int):
        """Level of a zone on one axis: the lowest that spans <= axis_tiles
        tiles; beyond the highest, as without bounds, one tile for all."""
        extent = _extent(axis)
        level = F.lit(None).cast("int")
        for lv in range(self.max_levels - 1, -1, -1):
            span = self.side(axis, lv) * self.axis_tiles
            if math.isfinite(span):
                level = F.when(extent <= F.lit(span), F.lit(lv)).otherwise(level)
        return F.when(_bounded(axis), F.coalesce(level, F.lit(UNBOUNDED))).otherwise(F.lit(UNBOUNDED))

    def tile_span(self, axis: int, side):
        """Tile indexes a zone covers on one axis."""
        lo, hi = AXES[axis]
        inside = F.col(f"_l{axis}") != UNBOUNDED
        zero = F.lit(0).cast("bigint")
        return tuple(F.when(inside, F.floor(F.when(inside, F.col(c)) / side)).otherwise(zero) for c in (lo, hi))


def _fanout(axis: Axis, side: float, fanout: int, axis_tiles: int, max_levels: int) -> int:
    """The fanout with which ``max_levels`` levels reach the largest extent."""
    ratio = axis.max_extent / (side * axis_tiles)
    if ratio <= 1 or not math.isfinite(ratio):
        return fanout
    return max(fanout, math.ceil(ratio ** (1 / (max_levels - 1)) * (1 + 1e-9)))


def _with_level(zones: DataFrame, plan: TilePlan) -> DataFrame:
    z = _valid(zones).withColumns({f"_l{i}": plan.level_of(i) for i in (0, 1)})
    return z.withColumns({f"_s{i}": plan.side_col(i, F.col(f"_l{i}")) for i in (0, 1)})


def plan_tiles(zones: DataFrame, tile=None, fanout: int = 4, axis_tiles: int = 4, max_levels: int = 6,
               stats: ZoneStats | None = None) -> TilePlan:
    """Find the level pairs in use and count the zone tiles (a one-row
    aggregate, after the one of ``stats``).

    ``tile`` is a side for both axes or an (x, y) pair.  Every point is probed
    once per level pair in use, so an axis has at most ``max_levels`` levels:
    where zone sizes span more orders of magnitude, its fanout is computed from
    that span.  The tile count is exact, a proven bound for the broadcast
    decision.
    """
    if not 2 <= max_levels <= MAX_LEVELS:
        raise ValueError(f"max_levels must be 2 to {MAX_LEVELS}")
    if fanout < 2 or axis_tiles < 1:
        raise ValueError("fanout must be >= 2 and axis_tiles >= 1")
    stats = stats or ZoneStats(zones)
    if tile is None:
        sides = tuple(a.side for a in stats.axes)
    else:
        sides = tuple(tile) if isinstance(tile, (tuple, list)) else (tile, tile)
        if any(s <= 0 or not math.isfinite(s) for s in sides):
            raise ValueError("tile must be a positive number")
        sides = tuple(max(float(s), a.far / MAX_INDEX) for s, a in zip(sides, stats.axes))
    fanouts = tuple(_fanout(a, s, fanout, axis_tiles, max_levels) for a, s in zip(stats.axes, sides))
    plan = TilePlan(sides, fanouts, axis_tiles, max_levels)
    z = _with_level(zones, plan)
    (x0, x1), (y0, y1) = (plan.tile_span(i, F.col(f"_s{i}")) for i in (0, 1))
    r = z.agg(
        F.collect_set(F.struct("_l0", "_l1")).alias("levels"),
        F.sum((x1 - x0 + 1).cast("double") * (y1 - y0 + 1)).alias("n"),
    ).first()
    return TilePlan(sides, fanouts, axis_tiles, max_levels, [tuple(p) for p in r["levels"]], int(r["n"] or 0))


TILE_KEYS = ("lx", "ly", "tx", "ty")


def zone_tiles(zones: DataFrame, plan: TilePlan) -> DataFrame:
    """Every valid zone exploded into the tiles it covers: ``+ lx, ly, tx, ty``."""
    z = _with_level(zones, plan)
    (x0, x1), (y0, y1) = (plan.tile_span(i, F.col(f"_s{i}")) for i in (0, 1))
    return (
        z.withColumn("tx", F.explode(F.sequence(x0, x1)))
        .withColumn("ty", F.explode(F.sequence(y0, y1)))
        .withColumnsRenamed({"_l0": "lx", "_l1": "ly"})
        .drop("_s0", "_s1")
    )


def point_tiles(points: DataFrame, plan: TilePlan, px: str = "px", py: str = "py") -> DataFrame:
    """Every point with its tile at each level pair in use: ``+ lx, ly, tx, ty``."""
    def index(axis: int, level: int, c: str):
        if level == UNBOUNDED:
            return F.lit(0).cast("bigint")
        return F.floor(F.col(c) / F.lit(plan.side(axis, level)))

    def key(pair):
        return (F.lit(pair[0]), F.lit(pair[1]), index(0, pair[0], px), index(1, pair[1], py))

    if len(plan.levels) == 1:
        return points.select("*", *[c.alias(n) for c, n in zip(key(plan.levels[0]), TILE_KEYS)])
    keys = F.array(*[F.struct(*(c.alias(n) for c, n in zip(key(p), TILE_KEYS))) for p in plan.levels])
    return points.select("*", F.explode(keys).alias("_k")).select("*", *[f"_k.{n}" for n in TILE_KEYS]).drop("_k")


def hot_tiles(tiled_points: DataFrame, hot_share: int, max_salt: int) -> DataFrame:
    """Tiles holding more than 1 / ``hot_share`` of all point entries, and the
    number of parts to split each into: at most ``hot_share`` rows, found by one
    aggregate that is combined in every map task."""
    counts = tiled_points.groupBy(*TILE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.select((F.sum("n") / F.lit(float(hot_share))).alias("v")).scalar()
    parts = F.least(F.lit(max_salt), F.ceil(F.col("n") / limit).cast("int"))
    return counts.where(F.col("n") > limit).select(*TILE_KEYS, parts.alias("_parts"))


# ------------------------------------------------------------------ join


def zone_point_pairs(
    points: DataFrame,
    zones: DataFrame,
    *,
    px: str = "px",
    py: str = "py",
    strategy: str = AUTO,
    tile=None,
    fanout: int = 4,
    axis_tiles: int = 4,
    max_levels: int = 6,
    nested_loop_max_zones: int = NESTED_LOOP_MAX_ZONES,
    broadcast_max_bytes: int = 64 << 20,
    salt: int = 64,
    hot_share: int = 256,
    stats: ZoneStats | None = None,
) -> DataFrame:
    """Inner join of points with the zones that contain them.

    ``points`` needs ``px, py`` (doubles); ``zones`` needs ``x1, y1, x2,
    y2``.  All other columns of both sides are carried through.  Planning
    runs one or two one-row aggregates on the zone side only (count,
    bounding box, row width, tile levels); the point side stays lazy and is
    first cut to the zones' bounding box with a filter the scan can push down.

    In the shuffled join a tile with more than 1 / ``hot_share`` of the points
    is split into up to ``salt`` parts (``salt=1``: none is).  A point's part is
    a hash of its own columns, so a task that runs again deals it alike; points
    equal in every column share a part.  ``stats`` are those of ``zones`` if the
    caller has them already.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if not 2 <= max_levels <= MAX_LEVELS:
        raise ValueError(f"max_levels must be 2 to {MAX_LEVELS}")
    pred = _contains(px, py)
    stats = stats or ZoneStats(zones)
    valid = _valid(zones)
    points = points.filter(stats.point_filter(px, py))

    if strategy in (AUTO, NESTED_LOOP):
        if stats.n <= nested_loop_max_zones and stats.n * stats.row_bytes <= broadcast_max_bytes:
            return points.join(F.broadcast(valid), pred, "inner")
        if strategy == NESTED_LOOP:
            raise ValueError(f"nested_loop needs at most {nested_loop_max_zones} zones and {broadcast_max_bytes} bytes")

    plan = plan_tiles(valid, tile, fanout, axis_tiles, max_levels, stats)
    zt = zone_tiles(valid, plan)
    pt = point_tiles(points, plan, px, py)
    keys = list(TILE_KEYS)

    if strategy in (AUTO, TILED_BROADCAST):
        tile_bytes = plan.n_tiles * (stats.row_bytes + 16 * len(keys))
        if tile_bytes <= broadcast_max_bytes:
            return pt.join(F.broadcast(zt), keys, "inner").filter(pred).drop(*keys)
        if strategy == TILED_BROADCAST:
            raise ValueError(f"tiled_broadcast needs at most {broadcast_max_bytes} bytes, the zone tiles have {tile_bytes:.0f}")

    if salt > 1:
        part = F.xxhash64(*[F.col(f"`{c}`") for c in points.columns])
        if pt.isStreaming:
            # a stream cannot count its tiles beforehand: every tile has a few parts
            parts = F.lit(min(salt, 8))
            pt = pt.withColumn("_salt", F.pmod(part, parts))
            zt = zt.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (parts - 1).cast("bigint"))))
        else:
            hot = F.broadcast(hot_tiles(pt.select(*keys), hot_share, salt))  # at most hot_share rows
            parts = F.coalesce("_parts", F.lit(1))
            pt = pt.join(hot, keys, "left").withColumn("_salt", F.pmod(part, parts)).drop("_parts")
            zt = zt.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (parts - 1).cast("bigint")))).drop("_parts")
        keys = keys + ["_salt"]
    if strategy == TILED_SHUFFLE:
        # Asked for explicitly: keep the sort-merge join.  Under AUTO, AQE may
        # still broadcast a side whose *measured* size turns out small.
        zt = zt.hint("shuffle_merge")
    return pt.join(zt, keys, "inner").filter(pred).drop(*keys)


def count_per_zone(pairs: DataFrame) -> DataFrame:
    """``rectangle, value`` = matched points per zone text, ascending by text.

    The count is partially aggregated in every map task, so only
    ``#tasks x #zones`` rows are shuffled.  Duplicate rectangle rows add up
    (they join separately and share the text key); zones without points are
    absent.
    """
    return pairs.groupBy("rectangle").agg(F.count("rectangle").alias("value")).orderBy("rectangle")


def hot_zones(points: DataFrame, zones: DataFrame, **join_options) -> DataFrame:
    """Points per rectangle: ``rectangle string, value bigint`` sorted by text.

    Only counts are asked for, so ``strategy`` has one choice more than in
    :func:`zone_point_pairs`: ``cover`` joins cells that a zone holds with the
    number of their points, and compares points at a zone's edges only.  AUTO
    takes it for more than ``nested_loop_max_zones`` zones.  The options of the
    cover are those of :func:`spacetime.operators.covers.cover_counts`.
    """
    px, py = join_options.get("px", "px"), join_options.get("py", "py")
    pts = points.select(px, py)
    zs = zones.select("rectangle", *ZONE_COLS)
    options = {k: v for k, v in join_options.items() if k in COVER_OPTIONS}
    strategy = join_options.get("strategy", AUTO)
    # an option of the tile join asks for it
    if strategy == COVER or (strategy == AUTO and not pts.isStreaming and set(join_options) <= COVER_OPTIONS | {"strategy", "nested_loop_max_zones"}):
        stats = ZoneStats(zs)
        few = stats.n <= join_options.get("nested_loop_max_zones", NESTED_LOOP_MAX_ZONES)
        if strategy == COVER or not few:
            axes = stats.axes
            frame = Frame(tuple(a.low or 0.0 for a in axes), tuple(a.high or 0.0 for a in axes))
            inside = pts.filter(stats.point_filter(px, py))
            return cover_counts(inside, _valid(zs), frame, stats.n, stats.row_bytes, **options).orderBy("rectangle")
        join_options["stats"] = stats
    return count_per_zone(zone_point_pairs(pts, zs, **{k: v for k, v in join_options.items() if k not in COVER_ONLY}))
