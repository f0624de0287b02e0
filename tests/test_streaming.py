import os
import random

import pytest

from spacetime.functions.grid import GridSpec
from spacetime.operators.zones import zones_from_text
from spacetime.plans.jobs import hot_cell_analysis, hot_zone_analysis
from spacetime.streaming.hotspots import (
    publish,
    read_latest,
    read_parquet_stream,
    read_points_stream,
    run_to_table,
    start_hot_cells,
    start_zone_counts,
    stream_location,
)

RECTS = ["-74.5,40.5,-74.2,40.7", "-74.1,40.6,-73.8,40.9", "-74.0,40.7,-73.95,40.75"]


def write_point_files(folder, n_files, rows_per_file, seed):
    rnd = random.Random(seed)
    os.makedirs(folder, exist_ok=True)
    for f in range(n_files):
        lines = []
        for i in range(rows_per_file):
            x = rnd.choice([-73.98, -74.41, -73.7, -74.0]) + rnd.uniform(-0.03, 0.03)
            y = rnd.choice([40.75, 40.52, 40.9, 40.7]) + rnd.uniform(-0.03, 0.03)
            day = rnd.choice([1, 2, 15, 30, 31])
            lines.append(f"r{f}_{i};2010-01-{day:02d} {rnd.randint(0, 23):02d}:10:00;a;b;c;({x:.6f},{y:.6f})")
        with open(os.path.join(folder, f"part{f:03d}.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")


def test_stream_hot_cells_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    write_point_files(src, 4, 300, seed=1)
    out, ckpt = stream_location(spark, "test-cells")
    pts = read_points_stream(spark, src, max_files_per_trigger=1)  # 4 micro-batches
    q = start_hot_cells(pts, GridSpec.default(), out, ckpt, k=50)
    q.awaitTermination()
    assert q.exception() is None
    assert len(q.recentProgress) >= 4
    got = [tuple(r) for r in read_latest(spark, out).orderBy("x", "y", "z").collect()]
    want = [tuple(r) for r in hot_cell_analysis(spark, src).orderBy("x", "y", "z").collect()]
    assert got == want and len(got) > 0


def test_stream_zone_counts_restart_resumes(spark, scratch):
    src = os.path.join(scratch, "in")
    write_point_files(src, 2, 200, seed=2)
    rect_path = os.path.join(scratch, "rects.tsv")
    with open(rect_path, "w") as fh:
        fh.write("\n".join(RECTS) + "\n")
    zones = zones_from_text(spark.read.option("sep", "\t").csv(rect_path).withColumnRenamed("_c0", "rectangle"))
    out, ckpt = stream_location(spark, "test-zones")

    def run():
        q = start_zone_counts(read_points_stream(spark, src, max_files_per_trigger=1), zones, out, ckpt)
        q.awaitTermination()
        assert q.exception() is None

    run()
    first = sorted(tuple(r) for r in read_latest(spark, out).collect())
    assert first == [tuple(r) for r in hot_zone_analysis(spark, src, rect_path).collect()]
    # more files arrive; the restarted query reads only those and keeps its state
    more = os.path.join(scratch, "more")
    write_point_files(more, 2, 200, seed=3)
    for f in sorted(os.listdir(more)):
        os.replace(os.path.join(more, f), os.path.join(src, "new_" + f))
    run()
    got = sorted(tuple(r) for r in read_latest(spark, out).collect())
    assert got == [tuple(r) for r in hot_zone_analysis(spark, src, rect_path).collect()]
    assert sum(v for _, v in got) > sum(v for _, v in first)


def test_stream_hot_cells_clipped_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    write_point_files(src, 3, 300, seed=4)
    out, ckpt = stream_location(spark, "test-cells-clip")
    q = start_hot_cells(read_points_stream(spark, src, max_files_per_trigger=2), GridSpec.default(), out, ckpt,
                        k=50, clip=True, with_score=True)
    q.awaitTermination()
    assert q.exception() is None
    got = sorted(tuple(r) for r in read_latest(spark, out).collect())
    want = sorted(tuple(r) for r in hot_cell_analysis(spark, src, clip=True).collect())
    assert [g[:3] for g in got] == want and len(got) > 0


def test_run_to_table_reports_empty_streams(spark, scratch):
    import pytest

    from spacetime.streaming.hotspots import run_to_table

    src = os.path.join(scratch, "empty")
    os.makedirs(src)
    pts = read_points_stream(spark, src)
    with pytest.raises(ValueError):
        run_to_table(spark, lambda out, ck: start_hot_cells(pts, GridSpec.default(), out, ck), "empty")


def test_part_file_folders_stream_like_single_files(spark, scratch):
    whole = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    whole.repartition(5).write.parquet(os.path.join(scratch, "events.parquet"))
    for folder in (scratch, "/root/testdata/sf0.001"):
        stream = read_parquet_stream(spark, folder, "events.parquet")
        out, ckpt = stream_location(spark, "test-folder")
        q = stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).format("parquet").start(out)
        q.awaitTermination()
        assert spark.read.parquet(out).count() == whole.count()


def test_timeout_stops_the_query_and_raises(spark, scratch):
    src = os.path.join(scratch, "in")
    write_point_files(src, 6, 50, seed=5)
    started = []

    def start(out, ckpt):
        pts = read_points_stream(spark, src, max_files_per_trigger=1)
        started.append(start_hot_cells(pts, GridSpec.default(), out, ckpt, trigger={"processingTime": "1 second"}))
        return started[0]

    with pytest.raises(TimeoutError):
        run_to_table(spark, start, "test-timeout", timeout_s=2)
    assert not started[0].isActive


def test_readers_find_whole_versions_only(spark, scratch):
    out = os.path.join(scratch, "result")
    with pytest.raises(ValueError):
        read_latest(spark, out)
    for batch in range(6):
        if batch:  # a version being written is not seen
            spark.range(batch + 1).write.parquet(f"{out}/version={batch}")
            assert read_latest(spark, out).count() == batch
        publish(spark.range(batch + 1), out, batch)
    assert read_latest(spark, out).count() == 6
    assert sorted(d for d in os.listdir(out) if d.startswith("version")) == ["version=3", "version=4", "version=5"]


def test_state_is_read_once_per_micro_batch(spark, scratch):
    """However often the ranking reads the counts, one stage restores and saves state."""
    src = os.path.join(scratch, "in")
    write_point_files(src, 1, 200, seed=6)
    out, ckpt = stream_location(spark, "test-once")
    q = start_hot_cells(read_points_stream(spark, src), GridSpec.default(), out, ckpt)
    q.awaitTermination()
    assert q.exception() is None
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in progress] == [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert progress[0]["numInputRows"] == 200


def test_a_long_stream_keeps_few_files(spark, scratch):
    """100 versions published: the files there do not grow with their number."""
    out = os.path.join(scratch, "long")
    one = spark.range(1).coalesce(1)
    sizes = []
    for batch in range(100):
        publish(one, out, batch)
        sizes.append(sum(len(files) for _, _, files in os.walk(out)))
    assert max(sizes[5:]) == min(sizes[5:]) and sizes[-1] < 40
    assert read_latest(spark, out).count() == 1
    assert not [f for f in os.listdir(out) if f.endswith(".new")]
    # a batch that runs again is published again
    publish(spark.range(7), out, 99)
    assert read_latest(spark, out).count() == 7
