"""Inputs that used to lose or change data without a word."""

import pytest
from pyspark.sql import functions as F

from gridpanel.operators.geometry import dissolve_by_name
from gridpanel.operators.joins import sized_broadcast
from gridpanel.operators.reshape import melt_years
from gridpanel.plans.annual import annual_means, direct_annual_means
from gridpanel.plans.panels import clean_co2
from gridpanel.plans.publish import load_partitions
from gridpanel.session import scratch_path
from gridpanel.sinks.files import read_text, write_single_csv
from gridpanel.sources.grid import GridSpec, array_grid_to_long, as_rows, read_grid_years
from gridpanel.sources.polygons import read_geojson_features
from gridpanel.sources.tables import read_co2_csv

from conftest import poly, regions_df


def box(x, y, h=1.0):
    return [poly([(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)])]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 12, 16])
def test_rows_of_a_vector_keep_every_value(spark, n):
    df = spark.createDataFrame([(1, [float(i) for i in range(n)])], "time int, v array<double>")
    got = array_grid_to_long(df.select("time", as_rows(F.col("v"), 8).alias("rows")), values="rows").collect()
    assert sorted((r.lat_pos * 8 + r.lon_pos, r.v) for r in got) == [(i, float(i)) for i in range(n)]


def test_regions_of_one_name_are_one_region(spark):
    facts = spark.createDataFrame([(2000, 0.5, 0.5, 1.5), (2000, 10.5, 10.5, -4.5)], "y int, lat double, lon double, v double") \
        .select(F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp").alias("time"), F.col("y").alias("year"), "lat", "lon", "v")
    grid = GridSpec(0.5, 10.0, 2, 0.5, 10.0, 2)
    regions = regions_df(spark, [(0, "X", box(0.5, 0.5)), (1, "X", box(10.5, 10.5))])
    want = direct_annual_means(facts, dissolve_by_name(regions), grid).select("country", "year", "temp_c").collect()
    assert direct_annual_means(facts, regions, grid).select("country", "year", "temp_c").collect() == want
    out, _ = annual_means(facts, regions, grid, buffer_m=0.0)
    assert [(r.country, r.year, round(r.temp_c, 9)) for r in out.collect()] == [(r.country, r.year, round(r.temp_c, 9)) for r in want]
    assert len(want) == 1 and -4.5 < want[0].temp_c < 1.5


def co2(spark, years):
    path = scratch_path(spark, "co2")
    spark.createDataFrame([("FRA", "France", y, "1.5") for y in years], "iso_code string, country string, year string, co2 string") \
        .write.option("header", True).csv(path)
    return clean_co2(read_co2_csv(spark, path), 1990, None)


def test_a_co2_year_that_cannot_be_read_fails(spark):
    assert sorted(r.year for r in co2(spark, ["2000", "2001.0"]).collect()) == [2000, 2001]
    for bad in ("20x0", None):
        with pytest.raises(Exception, match="year"):
            co2(spark, ["2000", bad]).collect()


def test_indicator_gaps_are_null(spark):
    df = spark.createDataFrame([("FRA", "s", "1.5", "..", "NaN", None)], "iso3 string, series string, yr2000 string, yr2001 string, yr2002 string, yr2003 string")
    assert [(r.year, r.value) for r in melt_years(df, ["iso3", "series"]).orderBy("year").collect()] == [
        (2000, 1.5), (2001, None), (2002, None), (2003, None)]


def test_geojson_ids_run_through_all_files(spark):
    path = scratch_path(spark, "geo")
    for name, n in (("a", 2), ("b", 1), ("c", 2)):
        f = '{"type":"Feature","properties":{"name":"%s"},"geometry":null}' % name
        spark.createDataFrame([('{"type":"FeatureCollection","features":[' + ",".join([f] * n) + "]}",)], "v string") \
            .coalesce(1).write.text(f"{path}/{name}")
    got = read_geojson_features(spark, f"{path}/*").select("feature_pos", "properties.name").orderBy("feature_pos").collect()
    assert [tuple(r) for r in got] == [(0, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "c")]


def test_uneven_axes_are_refused(spark):
    rows = [(float(a), float(o)) for a in (0, 1, 2, 4) for o in (0, 1)]
    with pytest.raises(ValueError, match="latitude.*followed by 4"):
        GridSpec.from_facts(spark.createDataFrame(rows, "lat double, lon double"))


def test_missing_years_are_listed_without_reading_facts(spark):
    path = scratch_path(spark, "grid")
    spark.createDataFrame([(2000, "not a grid")], "year int, x string").write.partitionBy("year").parquet(path)
    spark.sparkContext.setJobGroup("listing", "")
    with pytest.raises(FileNotFoundError, match="2001"):
        read_grid_years(spark, path, [2000, 2001])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_every_partition_is_checked_and_null_keys_are_refused(spark):
    path = scratch_path(spark, "annual")
    spark.createDataFrame([("A", 1.0)], "country string, temp_c double").write.parquet(f"{path}/year=2000")
    assert load_partitions(spark, path).count() == 1
    spark.createDataFrame([("B", 1.0)], "country string, other double").write.parquet(f"{path}/year=2001")
    with pytest.raises(ValueError, match="year=2001"):
        load_partitions(spark, path)
    assert load_partitions(spark, path, max_year=2000).count() == 1
    spark.createDataFrame([(None, 1.0)], "country string, temp_c double").write.parquet(f"{path}/year=2002")
    with pytest.raises(Exception, match="country"):
        load_partitions(spark, path, min_year=2002).collect()


def test_long_strings_are_not_broadcast(spark):
    df = spark.range(40).select("id", F.repeat(F.lit("x"), 100_000).alias("s"))
    assert "ResolvedHint" not in sized_broadcast(df, 1 << 20)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in sized_broadcast(df.select("id"), 1 << 20)._jdf.queryExecution().analyzed().toString()


def test_csv_is_replaced_in_one_step_and_sorted(spark):
    dst = scratch_path(spark, "one") + ".csv"
    write_single_csv(spark.createDataFrame([("old",)], "c string"), dst)
    df = spark.createDataFrame([(c,) for c in ["b", None, "a", "c"]], "c string").repartition(4)
    write_single_csv(df, dst, sort=["c"])
    assert read_text(spark, dst).split("\n")[:4] == ["c", "a", "b", "c"]
