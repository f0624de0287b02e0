"""The two analyses over a stream of points (Structured Streaming).

* :func:`zone_counts_stream` -- stream-static join of the points with the
  zones (same strategies as the batch join) and a running count per
  rectangle.  State = one row per rectangle.
* :func:`cell_counts_stream` -- running count per grid cell.  State = one
  row per populated cell, independent of the number of points.
* :func:`start_hot_cells` -- cell counts in ``complete`` mode, and per
  micro-batch the Gi* ranking of the whole count table
  (``foreachBatch``): the grid-wide mean and deviation change with every
  point, so every populated cell is re-scored from the counts, never from
  the points.

Every micro-batch writes a version of the result of its own and then replaces
the manifest, one small file with the version's number, in one step; so a reader
(:func:`read_latest`) always finds a whole version.  The last ``KEEP_VERSIONS``
stay, and a stream that runs for ever keeps a bounded number of files.  Progress is checkpointed under
``spark.checkpoint.dir``, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spacetime.functions.geometry import STRICT
from spacetime.functions.grid import GridSpec, grid_point_filter
from spacetime.operators.cells import assign_cells, cell_counts
from spacetime.operators.gistar import score_cells, top_cells
from spacetime.operators.zones import ZONE_COLS, points_from_text, zone_point_pairs
from spacetime.session import checkpoint_dir
from spacetime.sources.csv import POINT_FILE_SCHEMA, POINT_POS, POINT_SEP, POINT_TIME_POS

# ------------------------------------------------------------------ sources


def read_points_stream(spark: SparkSession, path: str, mode: str = STRICT,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Directory of point CSV files as a stream of ``px, py, t``."""
    r = spark.readStream.schema(POINT_FILE_SCHEMA).option("sep", POINT_SEP).option("header", "false")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.csv(path)
    text = raw.select(raw[f"_c{POINT_TIME_POS}"].alias("pickup_time"), raw[f"_c{POINT_POS}"].alias("point"))
    return points_from_text(text, "point", mode, time_col="pickup_time")


def read_parquet_stream(spark: SparkSession, directory: str, file_glob: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """The parquet table ``directory/file_glob`` as a stream: files of that
    name or pattern, or the part files of a folder of that name."""
    found = spark.read.parquet(f"{directory.rstrip('/')}/{file_glob}")
    folders = {f.rsplit("/", 2)[-2] for f in found.inputFiles()}
    r = spark.readStream.schema(found.schema)
    if folders == {file_glob}:
        directory = f"{directory.rstrip('/')}/{file_glob}"
    else:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(directory)


# ------------------------------------------------------------------ plans


def zone_counts_stream(points: DataFrame, zones: DataFrame, **join_options) -> DataFrame:
    """Running ``rectangle, value`` over a point stream and static zones."""
    px, py = join_options.get("px", "px"), join_options.get("py", "py")
    pairs = zone_point_pairs(points.select(px, py), zones.select("rectangle", *ZONE_COLS), **join_options)
    return pairs.groupBy("rectangle").count().withColumnRenamed("count", "value")


def cell_counts_stream(points: DataFrame, spec: GridSpec, x: str = "px", y: str = "py", t: str = "t",
                       clip: bool = False) -> DataFrame:
    """Running ``x, y, z, n`` per populated cell."""
    if clip:
        points = points.filter(grid_point_filter(x, y, spec))
    return cell_counts(assign_cells(points, spec, x, y, t), spec, clip=clip)


# ------------------------------------------------------------------ sinks


def stream_location(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output table path, checkpoint path) for a new stream under the shared folder."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/spacetime-streams/{name}-{uuid.uuid4().hex[:12]}"
    return f"{base}/out", f"{base}/checkpoint"


KEEP_VERSIONS = 3
MANIFEST = "latest"


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` into the file ``path`` in one step: it is written beside it
    and renamed over it, so a reader sees the old text or the new one."""
    fs, conf = _hadoop(spark)
    target = fs.Path(path)
    beside = fs.Path(f"{path}.{uuid.uuid4().hex}.new")
    out = beside.getFileSystem(conf).create(beside, True)
    try:
        out.writeBytes(text)
    finally:
        out.close()
    how = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    how[0] = getattr(fs, "Options$Rename").OVERWRITE
    context = fs.FileContext.getFileContext(beside.getFileSystem(conf).getUri(), conf)
    context.rename(beside, target, how)


def publish(result: DataFrame, out_path: str, batch_id: int) -> None:
    """Write version ``batch_id`` of a result, then make it the latest.  A
    batch that runs again writes its version again.  Versions too old to stay
    are removed, whatever an earlier run left of them."""
    spark = result.sparkSession
    result.write.mode("overwrite").parquet(f"{out_path}/version={batch_id}")
    replace_text(spark, f"{out_path}/{MANIFEST}", str(batch_id))
    fs, conf = _hadoop(spark)
    folder = fs.Path(out_path)
    files = folder.getFileSystem(conf)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("version=") and int(name.partition("=")[2]) <= batch_id - KEEP_VERSIONS:
            files.delete(status.getPath(), True)


def read_latest(spark: SparkSession, out_path: str) -> DataFrame:
    """The latest published version of a stream's result; ``ValueError`` if
    nothing was published yet."""
    try:
        version = int(spark.read.text(f"{out_path}/{MANIFEST}").first()["value"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no output published under {out_path} (no input files?)") from e
    return spark.read.parquet(f"{out_path}/version={version}")


def _publishing(make, out_path: str):
    """A foreachBatch function: the micro-batch is kept while ``make`` reads it,
    however often, so that its state is restored and saved once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            publish(make(batch), out_path, batch_id)
        finally:
            batch.unpersist()

    return write


def start_zone_counts(points: DataFrame, zones: DataFrame, out_path: str, checkpoint: str,
                      trigger: dict | None = None, **join_options) -> StreamingQuery:
    """Zone counts, complete mode; each micro-batch publishes a version sorted by text."""
    write = _publishing(lambda batch: batch.orderBy("rectangle"), out_path)
    counts = zone_counts_stream(points, zones, **join_options)
    w = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_hot_cells(points: DataFrame, spec: GridSpec, out_path: str, checkpoint: str, k: int = 50,
                    with_score: bool = False, clip: bool = False, trigger: dict | None = None,
                    x: str = "px", y: str = "py", t: str = "t") -> StreamingQuery:
    """Top-k Gi* cells, re-ranked from the full count state every micro-batch."""
    write = _publishing(lambda batch: top_cells(score_cells(batch, spec), k, with_score), out_path)
    counts = cell_counts_stream(points, spec, x, y, t, clip)
    w = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def run_to_table(spark: SparkSession, start, name: str, timeout_s: float | None = None) -> DataFrame:
    """Start a stream on everything available, wait for it, read its table back.

    If it is not through after ``timeout_s`` seconds it is stopped and
    ``TimeoutError`` is raised: what it has by then is not the whole result.
    """
    out, ckpt = stream_location(spark, name)
    q = start(out, ckpt)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {name!r} was not through after {timeout_s} s")
    if q.exception() is not None:
        raise q.exception()
    return read_latest(spark, out)
