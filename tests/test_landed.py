"""Footers read in tasks, input order as a sort key, runs and tiles against cells."""

import random

import pytest
from pyspark.sql import functions as F

from gridpanel.operators.cover import scanline_cover
from gridpanel.operators.geometry import region_edges
from gridpanel.operators.reshape import pivot_series
from gridpanel.operators.runs import monthly_over_runs, runs_of, scanline_runs
from gridpanel.operators.source_order import SOURCE_ORDER, with_line_order, with_source_order
from gridpanel.operators.spatial_agg import regional_monthly
from gridpanel.operators.tiles import monthly_over_tiles, tile_facts, tile_weights
from gridpanel.plans.publish import REQUIRED, load_partitions, publish_rows
from gridpanel.session import scratch_path
from gridpanel.sources.footers import parquet_footers, partition_files, partition_problems
from gridpanel.sources.grid import GridSpec, with_cell_keys
from gridpanel.sources.tables import landed_partition_report

from conftest import poly, regions_df


def write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


# -- footers -----------------------------------------------------------------------------

def test_every_file_of_a_partition_is_looked_at(spark):
    path = scratch_path(spark, "drift")
    write(spark, [("A", 1.0)], "country string, temp_c double", f"{path}/year=2000")
    write(spark, [("A", "1")], "country string, temp_c string", f"{path}/year=2000")
    write(spark, [("A", 1)], "country string, temp_c int", f"{path}/year=2001")
    write(spark, [("A", 1.0)], "country string, temp_c double", f"{path}/year=2002")
    write(spark, [(1.0, 2)], "temp_c double, extra int", f"{path}/year=2003")
    spark.createDataFrame([("no footer here",)], "v string").coalesce(1).write.text(f"{path}/year=2004")
    files = partition_files(spark, path, REQUIRED)
    got = {(r.year, r.problem, r.n_files) for r in partition_problems(files).collect()}
    assert got == {(2000, "temp_c (string, not double)", 1), (2001, "temp_c (int, not double)", 1),
                   (2003, "country (lacking)", 1), (2003, "extra (not expected)", 1)}
    assert {r.year: r.n for r in files.groupBy("year").agg(F.count("*").alias("n")).collect()} == {2000: 2, 2001: 1, 2002: 1, 2003: 1}
    with pytest.raises(ValueError, match=r"2 files .*year=2000.*temp_c \(string, not double\); .*year=2001"):
        load_partitions(spark, path, max_year=2001)
    assert [tuple(r) for r in load_partitions(spark, path, 2002, 2002).collect()] == [("A", 2002, 1.0)]


def test_a_broken_file_is_a_row_of_the_report(spark):
    path = scratch_path(spark, "broken")
    rows = [(f"2000-{m:02d}-01", 1.0) for m in range(1, 13)]
    for y in (2000, 2001):
        write(spark, rows, "t string, v double", f"{path}/year={y}")
    broken = scratch_path(spark, "text")
    spark.createDataFrame([("no parquet",)], "v string").coalesce(1).write.text(broken)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(broken).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = [s.getPath() for s in fs.listStatus(fs_path(broken)) if s.getPath().getName().startswith("part-")][0]
    fs.rename(part, fs_path(f"{path}/year=2001/part-99999.parquet"))
    errors = [r.error for r in parquet_footers(spark, path).where("error is not null").collect()]
    assert len(errors) == 1
    report = landed_partition_report(spark, path, ["t", "v"], time_col="t")
    assert {r.year: (r.n_months, r.valid) for r in report.collect()} == {2000: (12, True), 2001: (0, False)}


# -- input order -------------------------------------------------------------------------

def test_first_row_in_the_files_is_published(spark):
    path = scratch_path(spark, "ordered")
    rows = [("A", 3.0), ("B", 1.0), ("A", 1.0), ("A", 2.0), ("B", 0.5), (chr(67), None), (chr(67), 4.0)]
    write(spark, rows, "country string, temp_c double", f"{path}/year=2000")
    df = load_partitions(spark, path, ordered=True)
    assert [tuple(r) for r in publish_rows(df.repartition(5)).collect()] == [("A", 2000, 3.0), ("B", 2000, 1.0), ("C", 2000, None)]


def test_order_of_files_and_of_csv_lines(spark):
    path, csv = scratch_path(spark, "files"), scratch_path(spark, "csv")
    df = spark.range(0, 5000, 1, 6).select("id")
    df.write.parquet(path)
    df.write.option("header", True).csv(csv)
    for scan in (with_source_order(spark.read.parquet(path)),
                 with_line_order(spark.read.option("header", True).option("maxPartitionBytes", 500).csv(csv))):
        assert [int(r.id) for r in scan.repartition(7).orderBy(SOURCE_ORDER).collect()] == list(range(5000))


def test_pivot_takes_the_first_value_in_order(spark):
    rows = [("A", 2000, "s", 5.0, 2), ("A", 2000, "s", 1.0, 3), ("A", 2000, "s", None, 1), ("A", 2001, "t", 7.0, 1)]
    df = spark.createDataFrame(rows, "iso3 string, year int, series string, value double, place int")
    got = pivot_series(df, ["iso3", "year"], "series", ["s", "t"], order_col="place").orderBy("year").collect()
    assert [tuple(r) for r in got] == [("A", 2000, 5.0, None), ("A", 2001, None, 7.0)]
    assert pivot_series(df, ["iso3", "year"], "series", ["s"]).orderBy("year").first().s == 1.0


# -- runs and tiles ----------------------------------------------------------------------

GRID = GridSpec(-40.0, 2.5, 33, -90.0, 2.5, 73, False)


def shapes(seed):
    r = random.Random(seed)
    out = []
    for i in range(12):
        parts = []
        for _ in range(r.randint(1, 3)):        # parts may overlap, a ring may cross itself
            cx, cy, n = r.uniform(-85, 85), r.uniform(-38, 38), r.randint(3, 9)
            parts.append(poly([(cx + r.uniform(-25, 25), cy + r.uniform(-18, 18)) for _ in range(n)]))
        out.append((i, f"r{i}", parts))
    square = [(-10.0, -10.0), (10.0, -10.0), (10.0, 10.0), (-10.0, 10.0)]      # on the grid's lines
    hole = [(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0)]
    return [*out, (90, "square", [poly(square, hole)]), (91, "wide", [poly([(-300.0, 0.0), (300.0, 0.0), (300.0, 5.1), (-300.0, 5.1)])])]


def facts(spark, seed):
    r = random.Random(seed)
    rows = []
    for month in (1, 2, 3):
        for _ in range(1500):
            lat, lon = -40.0 + 2.5 * r.randrange(33), -90.0 + 2.5 * r.randrange(73)
            rows.append((f"2000-{month:02d}-01", 2000, lat, lon, None if r.random() < 0.2 else r.uniform(-30, 40)))
    return spark.createDataFrame(rows, "time string, year int, lat double, lon double, v double")


def close(a, b, keys):
    one, two = ({tuple(x[k] for k in keys): x.mt for x in df.collect()} for df in (a, b))
    assert one.keys() == two.keys()
    for k, v in one.items():
        assert (v is None) == (two[k] is None) and (v is None or abs(v - two[k]) < 1e-9), k


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_are_the_cover(spark, seed):
    edges = region_edges(regions_df(spark, shapes(seed))).cache()
    cells = scanline_cover(edges, GRID)
    runs = scanline_runs(edges, GRID).cache()
    spread = runs.select("region_id", "ilat", F.explode(F.sequence("c0", "c1")).alias("ilon"))
    assert spread.exceptAll(cells).count() == 0 and cells.exceptAll(spread).count() == 0
    assert runs_of(cells).exceptAll(runs).count() == 0 and runs.count() < cells.count() / 3
    f = facts(spark, seed)
    for weighted in (True, False):
        close(monthly_over_runs(f, GRID, runs, weighted), regional_monthly(with_cell_keys(f, GRID), cells, weighted),
              ["region_id", "year", "time"])


def test_tiles_are_the_long_path(spark):
    cells = scanline_cover(region_edges(regions_df(spark, shapes(3))), GRID)
    one = facts(spark, 3).groupBy("time", "year", "lat", "lon").agg(F.avg("v").alias("v"))
    long_ = regional_monthly(with_cell_keys(one, GRID), cells).where("mt is not null")
    for size in ((16, 16), (5, 7)):
        got = monthly_over_tiles(tile_facts(one, GRID, *size), tile_weights(cells, GRID, True, *size))
        close(got, long_, ["region_id", "year", "time"])


def test_a_band_of_the_polygon_table_is_pushed_to_the_scan(spark):
    from gridpanel.sources.polygons import read_region_table, write_region_table

    rows = [(i, f"r{i}", [poly([(0.0, float(i)), (1.0, float(i)), (1.0, i + 1.5), (0.0, float(i))])]) for i in range(-40, 40)]
    regions = regions_df(spark, [*rows, (99, "none", None)])
    path = scratch_path(spark, "regions")
    write_region_table(regions.repartition(4), path)
    band = read_region_table(spark, path, 10.0, 12.0)
    assert sorted(r.region_id for r in band.collect()) == [9, 10, 11, 12]
    assert band.schema == regions.schema
    plan = band._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lat_max), IsNotNull(lat_min)" in plan
    assert read_region_table(spark, path).exceptAll(regions).count() == 0 and read_region_table(spark, path).count() == 81
