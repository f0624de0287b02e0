"""Hot cells of a stream, ranked from what a micro-batch changed.

:func:`spacetime.streaming.hotspots.start_hot_cells` scores every populated cell
again in each micro-batch.  Here the neighbourhood sums are keyed state: a block
of cells keeps the count and the sum of each of its cells, a batch's points reach
their block and the blocks they border on, and only cells whose count or sum
changed leave the operator.  From those, and from a bounded table of the leaders
so far, the ranking is made anew:

* the grid-wide moments move by the differences of the changed counts;
* all scores move with the moments, but among cells with equally many in-grid
  neighbours (one weight) the score grows with the sum, and sums never fall.  So
  a cell that did not change can only be among the first ``k`` if it was among
  the first ``k`` of its weight before.  The leaders are the first ``k`` of every
  weight by sum, and by coordinates (the order where there is no score).

The result equals that of the batch ranking.  Leaders, moments and report are
versions published as in :mod:`spacetime.streaming.hotspots`; a batch that runs
again starts from the version before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spacetime.functions.grid import GridSpec, grid_point_filter, neighbor_weight
from spacetime.operators.cells import assign_cells, with_moments
from spacetime.operators.gistar import gi_star, top_cells
from spacetime.operators.neighbors import halo_blocks
from spacetime.streaming.hotspots import _hadoop, publish

#: Cells per side of a state block on x and y, and on z.
BLOCK, DEPTH = 16, 32
CHANGED = "x long, y long, z long, n_old long, n long, sum1 long"


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells of a task's points with their counts."""
    for pdf in batches:
        yield pdf.groupby(["x", "y", "z"], as_index=False).size().rename(columns={"size": "n"})


def _in_grid(c: np.ndarray, spec: GridSpec) -> np.ndarray:
    low, high = np.array([spec.min_x, spec.min_y, spec.min_z]), np.array([spec.max_x, spec.max_y, spec.max_z])
    return ((c >= low) & (c <= high)).all(axis=1)


def merged(cells: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells with their summed counts and sums."""
    distinct, which = np.unique(cells, axis=0, return_inverse=True)
    total_n, total_s = np.zeros(len(distinct), dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
    np.add.at(total_n, which.ravel(), n)
    np.add.at(total_s, which.ravel(), s)
    return distinct, total_n, total_s


def contributions(cells: np.ndarray, n: np.ndarray, block: np.ndarray, spec: GridSpec, side: int = BLOCK, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What new points of ``cells`` (the block's own and its halo) add to the
    counts and sums of the block's cells."""
    first = block * np.array([side, side, depth])
    last = first + np.array([side, side, depth]) - 1
    home = ((cells >= first) & (cells <= last)).all(axis=1)
    out = [(cells[home], n[home], np.zeros(int(home.sum()), dtype=np.int64))]
    inside = _in_grid(cells, spec)
    for step in np.stack(np.meshgrid(*[[-1, 0, 1]] * 3, indexing="ij"), axis=-1).reshape(-1, 3):
        to = cells[inside] + step
        ok = ((to >= first) & (to <= last)).all(axis=1) & _in_grid(to, spec)
        out.append((to[ok], np.zeros(int(ok.sum()), dtype=np.int64), n[inside][ok]))
    return merged(*(np.concatenate([o[i] for o in out]) for i in range(3)))


def changed_cells(points: DataFrame, spec: GridSpec, x: str = "px", y: str = "py", t: str = "t", clip: bool = False) -> DataFrame:
    """A stream of points as a stream of changed cells: ``x, y, z``, the count
    before and after, and the sum over the in-grid neighbourhood (0 off the grid)."""
    if clip:
        points = points.filter(grid_point_filter(x, y, spec))
    cells = assign_cells(points, spec, x, y, t).where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    if clip:
        cells = cells.where(F.col("x").between(spec.min_x, spec.max_x) & F.col("y").between(spec.min_y, spec.max_y) & F.col("z").between(spec.min_z, spec.max_z))
    counted = cells.select("x", "y", F.col("z").cast("long").alias("z")).mapInPandas(_combined, "x long, y long, z long, n long")
    dealt = halo_blocks(counted, BLOCK, DEPTH)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(batches))
        new = new.groupby(["x", "y", "z"], as_index=False)["n"].sum()
        add = contributions(new[["x", "y", "z"]].to_numpy(dtype=np.int64), new["n"].to_numpy(dtype=np.int64), np.array(key, dtype=np.int64), spec)
        if state.exists:
            (blob,) = state.get
            kept = np.frombuffer(blob, dtype=np.int64).reshape(-1, 5)
        else:
            kept = np.zeros((0, 5), dtype=np.int64)
        cells, n, s = merged(np.concatenate([kept[:, :3], add[0]]), np.r_[kept[:, 3], add[1]], np.r_[kept[:, 4], add[2]])
        state.update((np.column_stack([cells, n, s]).tobytes(),))
        # rows of the changed cells, by their place among all (both are sorted alike)
        rows = {tuple(c): i for i, c in enumerate(cells.tolist())}
        at = np.array([rows[tuple(c)] for c in add[0].tolist()], dtype=np.int64)
        out = pd.DataFrame(cells[at], columns=["x", "y", "z"])
        out["n_old"], out["n"], out["sum1"] = n[at] - add[1], n[at], s[at]
        yield out[out["n"] > 0]

    return dealt.groupBy("bx", "by", "bz").applyInPandasWithState(update, CHANGED, "cells binary", "update", GroupStateTimeout.NoTimeout)


def before(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """The last version before ``batch_id`` of a published table, or no rows."""
    fs, conf = _hadoop(spark)
    folder = fs.Path(path)
    files = folder.getFileSystem(conf)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    versions = [int(n.partition("=")[2]) for n in names if n.startswith("version=")]
    versions = [v for v in versions if v < batch_id]
    return spark.read.schema(schema).parquet(f"{path}/version={max(versions)}") if versions else spark.createDataFrame([], schema)


MOMENTS = "n_points decimal(38,0), sum_sq decimal(38,0), changed long"
LEADERS = "x long, y long, z int, sum1 long, w long"


def moved(moments: DataFrame, changed: DataFrame) -> DataFrame:
    """The totals after a batch, and how many cells it changed."""
    def square(c):
        return (F.col(c).cast("decimal(19,0)") * F.col(c).cast("decimal(19,0)")).cast("decimal(38,0)")

    moves = changed.select((F.col("n") - F.col("n_old")).cast("decimal(38,0)").alias("n_points"), (square("n") - square("n_old")).cast("decimal(38,0)").alias("sum_sq"), F.lit(1).cast("long").alias("changed"))
    both = moments.select("n_points", "sum_sq", F.lit(0).cast("long").alias("changed")).unionByName(moves)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in (("n_points", "decimal(38,0)"), ("sum_sq", "decimal(38,0)"), ("changed", "long"))])


def led(leaders: DataFrame, changed: DataFrame, spec: GridSpec, k: int) -> DataFrame:
    """The leaders after a batch: the first ``k`` of each weight by sum, and by
    coordinates.  Sums never fall, so a cell's largest sum is its latest."""
    z = F.col("z").cast("int").alias("z")
    inside = changed.where(F.col("x").between(spec.min_x, spec.max_x) & F.col("y").between(spec.min_y, spec.max_y) & F.col("z").between(spec.min_z, spec.max_z))
    now = inside.select("x", "y", z, "sum1").unionByName(leaders.select("x", "y", "z", "sum1"))
    now = now.groupBy("x", "y", "z").agg(F.max("sum1").alias("sum1")).withColumn("w", neighbor_weight("x", "y", "z", spec))
    place = [Window.partitionBy("w").orderBy(F.col("sum1").desc(), "x", "y", "z"), Window.partitionBy("w").orderBy("x", "y", "z")]
    first = [now.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r") for w in place]
    return first[0].union(first[1]).distinct()


def start_hot_cells_incremental(points: DataFrame, spec: GridSpec, out_path: str, checkpoint: str, k: int = 50, with_score: bool = False, clip: bool = False,
                                trigger: dict | None = None, x: str = "px", y: str = "py", t: str = "t") -> StreamingQuery:
    """Top-k Gi* cells as :func:`spacetime.streaming.hotspots.start_hot_cells`
    publishes them, at a cost per micro-batch that follows the cells it changed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            publish(moved(before(spark, f"{out_path}/moments", batch_id, MOMENTS), batch).coalesce(1), f"{out_path}/moments", batch_id)
            publish(led(before(spark, f"{out_path}/leaders", batch_id, LEADERS), batch, spec, k), f"{out_path}/leaders", batch_id)
        finally:
            batch.unpersist()
        totals = spark.read.parquet(f"{out_path}/moments/version={batch_id}").select(F.col("n_points").cast("bigint").alias("n_points"), F.col("sum_sq").cast("double").alias("sum_sq"))
        m = with_moments(totals, spec).select(F.struct("mean", "s").alias("m")).scalar()
        leaders = spark.read.parquet(f"{out_path}/leaders/version={batch_id}")
        scored = leaders.select("x", "y", "z", gi_star("sum1", "w", m["mean"], m["s"], spec.num_cells).alias("zscore"))
        publish(top_cells(scored, k, with_score), out_path, batch_id)

    w = changed_cells(points, spec, x, y, t, clip).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
