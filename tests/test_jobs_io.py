import csv
import glob
import os

import pytest

from spacetime.functions.grid import GridSpec
from spacetime.plans.jobs import hot_cell_analysis, hot_zone_analysis, register_views, run_batch
from spacetime.sources.csv import read_points_csv, read_rectangles_csv

POINT_ROWS = [
    'A;2009-01-31 12:05:00;p;q;r;"(-73.991957,40.721567)"',
    "B;2009-01-04 23:52:00;p;q;r;(-74.43,40.51)",
    "C;2009-01-04 01:00:00;p;q;r;(-74.435,40.505)",
    "D;2009-01-05 10:00:00;p;q;r;(-74.4295,40.5111)",
    "E;2009-01-31 12:00:00;p;q;r;(-80.0,40.7)",
]
RECT_ROWS = ["-74.5,40.5,-74.4,40.6", "-74.0,40.7,-73.9,40.8", "-74.0,40.7,-73.9,40.8", "0,0,1,1"]


def write_lines(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def read_csv_dir(path):
    rows = []
    for p in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(p) as f:
            rows += list(csv.reader(f))
    return rows


def test_point_reader_unquotes_and_selects(spark, scratch):
    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    rows = read_points_csv(spark, p).collect()
    assert rows[0].point == "(-73.991957,40.721567)" and rows[0].pickup_time == "2009-01-31 12:05:00"
    assert len(rows) == len(POINT_ROWS)


def test_rectangle_reader(spark, scratch):
    r = write_lines(os.path.join(scratch, "rects.tsv"), [x + "\textra" for x in RECT_ROWS])
    assert [x.rectangle for x in read_rectangles_csv(spark, r).collect()] == RECT_ROWS


def test_hot_zone_analysis_from_files(spark, scratch):
    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    r = write_lines(os.path.join(scratch, "rects.tsv"), RECT_ROWS)
    out = [tuple(x) for x in hot_zone_analysis(spark, p, r).collect()]
    assert out == [("-74.0,40.7,-73.9,40.8", 2), ("-74.5,40.5,-74.4,40.6", 3)]


def test_hot_cell_analysis_from_file(spark, scratch):
    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    out = hot_cell_analysis(spark, p).collect()
    cells = {tuple(x) for x in out}
    # B and C share cell (-7444, 4050, 4); D is (-7443, 4051, 5); E is off the grid
    assert cells == {(-7400.0, 4072.0, 31.0), (-7444.0, 4050.0, 4.0), (-7443.0, 4051.0, 5.0)}
    assert out[0].asDict() == {"x": -7444.0, "y": 4050.0, "z": 4.0}


def test_run_batch_writes_numbered_reports(spark, scratch):
    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    r = write_lines(os.path.join(scratch, "rects.tsv"), RECT_ROWS)
    prefix = os.path.join(scratch, "out")
    paths = run_batch(spark, prefix, [("HotZoneAnalysis", [p, r]), ("hotcellanalysis", [p])])
    assert paths == [prefix + "0", prefix + "1"]
    zone_parts = glob.glob(os.path.join(prefix + "0", "part-*"))
    assert len(zone_parts) == 1  # one file for the zone report
    assert read_csv_dir(prefix + "0") == [["-74.0,40.7,-73.9,40.8", "2"], ["-74.5,40.5,-74.4,40.6", "3"]]
    assert len(read_csv_dir(prefix + "1")) == 3
    # overwrite mode: running again replaces the reports
    run_batch(spark, prefix, [("hotzoneanalysis", [p, r])])
    assert read_csv_dir(prefix + "0")[0] == ["-74.0,40.7,-73.9,40.8", "2"]


def test_run_batch_rejects_bad_queries(spark, scratch):
    with pytest.raises(ValueError):
        run_batch(spark, os.path.join(scratch, "o"), [("hotzoneanalysis", ["only-one-path"])])
    with pytest.raises(KeyError):
        run_batch(spark, os.path.join(scratch, "o"), [("nosuchanalysis", ["x"])])


def test_permissive_mode_skips_bad_rows(spark, scratch):
    bad = POINT_ROWS + ["F;2009-02-31 00:00:00;p;q;r;(-74.0,40.7)", "G;2009-01-05;p;q;r;(-74.0,40.7)",
                        "H;2009-01-05 00:00:00;p;q;r;(abc,40.7)", "I;2009-01-05 00:00:00;p;q;r;(-73.9)"]
    p = write_lines(os.path.join(scratch, "bad.csv"), bad)
    out = hot_cell_analysis(spark, p, mode="permissive").collect()
    assert len(out) == 3
    with pytest.raises(Exception):
        hot_cell_analysis(spark, p).collect()


def test_empty_point_file(spark, scratch):
    p = write_lines(os.path.join(scratch, "empty.csv"), [])
    assert hot_cell_analysis(spark, p).collect() == []
    r = write_lines(os.path.join(scratch, "rects.tsv"), RECT_ROWS)
    assert hot_zone_analysis(spark, p, r).collect() == []


def test_register_views(spark, scratch):
    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    register_views(spark, trips=read_points_csv(spark, p))
    assert spark.sql("SELECT count(*) AS c FROM trips").first().c == len(POINT_ROWS)


def test_cli_arguments():
    from spacetime.plans.cli import parse_args

    a = parse_args(["--output", "o/r", "--query", "hotzoneanalysis", "p.csv", "r.tsv", "--query", "HotCellAnalysis", "p.csv"])
    assert a.output == "o/r"
    assert [(q[0], q[1:]) for q in a.query] == [("hotzoneanalysis", ["p.csv", "r.tsv"]), ("HotCellAnalysis", ["p.csv"])]


def test_cli_end_to_end(scratch):
    import subprocess
    import sys

    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    r = write_lines(os.path.join(scratch, "rects.tsv"), RECT_ROWS)
    prefix = os.path.join(scratch, "cli")
    cli = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "spacetime", "plans", "cli.py")
    out = subprocess.run([sys.executable, cli, "--output", prefix, "--query", "hotzoneanalysis", p, r,
                          "--query", "hotcellanalysis", p], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert read_csv_dir(prefix + "0") == [["-74.0,40.7,-73.9,40.8", "2"], ["-74.5,40.5,-74.4,40.6", "3"]]
    assert len(read_csv_dir(prefix + "1")) == 3


@pytest.mark.parametrize("single_file", [False, True])
def test_report_layout_is_the_callers_choice(spark, scratch, single_file):
    p = write_lines(os.path.join(scratch, "pts.csv"), POINT_ROWS)
    r = write_lines(os.path.join(scratch, "rects.tsv"), RECT_ROWS)
    prefix = os.path.join(scratch, "report")
    run_batch(spark, prefix, [("hotzoneanalysis", [p, r])], single_file=single_file)
    parts = sorted(f for f in os.listdir(prefix + "0") if f.startswith("part-"))
    assert not single_file or len(parts) == 1
    assert read_csv_dir(prefix + "0") == [["-74.0,40.7,-73.9,40.8", "2"], ["-74.5,40.5,-74.4,40.6", "3"]]


def test_cli_single_file_flag():
    from spacetime.plans.cli import parse_args

    assert parse_args(["--output", "o", "--single-file", "--query", "hotcellanalysis", "p.csv"]).single_file
    assert not parse_args(["--output", "o", "--query", "hotcellanalysis", "p.csv"]).single_file


def test_batch_reports_equal_duckdb_on_the_same_files(spark, scratch):
    """Whole benchmark tables written in the two file formats; the reports
    against DuckDB reading the same files."""
    import duckdb
    from pyspark.sql import functions as F

    from spacetime.functions.geometry import point_text
    from spacetime.sources.tables import events_lonlat_points

    sf = "/root/testdata/sf0.001"
    points, rects = os.path.join(scratch, "points"), os.path.join(scratch, "rects")
    ev = events_lonlat_points(spark, sf).select(
        F.col("event_id").cast("string").alias("id"), F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("t"),
        *[F.lit("f").alias(f"f{i}") for i in range(3)], point_text("px", "py").alias("p"))
    ev.write.option("sep", ";").option("quoteAll", "true").csv(points)
    spark.range(40).select(F.concat_ws(",", *[(F.lit(b) + F.col("id") * s).cast("string") for b, s in ((-74.5, 0.01), (40.5, 0.005), (-74.2, 0.01), (40.7, 0.005))])).write.option("sep", "\t").csv(rects)
    prefix = os.path.join(scratch, "out")
    run_batch(spark, prefix, [("hotzoneanalysis", [points, rects]), ("hotcellanalysis", [points])], single_file=True)
    con = duckdb.connect()
    con.execute(f"""CREATE VIEW p AS SELECT CAST(split_part(q, ',', 1) AS DOUBLE) AS px, CAST(split_part(q, ',', 2) AS DOUBLE) AS py,
        CAST(t AS TIMESTAMP) AS t FROM (SELECT replace(replace(column5, '(', ''), ')', '') AS q, column1 AS t
        FROM read_csv('{points}/*.csv', delim=';', header=false, all_varchar=true, names=['column0','column1','column2','column3','column4','column5']))""")
    con.execute(f"""CREATE VIEW r AS SELECT rect, [CAST(split_part(rect, ',', i) AS DOUBLE) FOR i IN [1, 2, 3, 4]] AS c
        FROM read_csv('{rects}/*.csv', delim='\t', header=false, all_varchar=true, names=['rect'])""")
    zones = con.sql("SELECT rect, count(*) FROM r JOIN p ON px BETWEEN c[1] AND c[3] AND py BETWEEN c[2] AND c[4] GROUP BY 1 ORDER BY 1").fetchall()
    assert [(a, int(b)) for a, b in read_csv_dir(prefix + "0")] == zones and zones
    from spacetime.plans import catalog

    sql = catalog._top_sql("SELECT px, py, t FROM p", catalog.GridSpec.default())
    assert [tuple(map(float, r)) for r in read_csv_dir(prefix + "1")] == con.sql(sql).fetchall()


def test_short_row_fails_strict_and_is_dropped_permissive(spark, scratch):
    p = write_lines(os.path.join(scratch, "short.csv"), POINT_ROWS + ["Z;2009-01-05 10:00:00;p"])  # no point column
    with pytest.raises(Exception):
        hot_cell_analysis(spark, p).collect()
    assert len(hot_cell_analysis(spark, p, mode="permissive").collect()) == 3
