"""End-to-end: landed files -> all outputs, compared with the registered queries."""

import json

from pyspark.sql import functions as F

from gridpanel.plans.catalog import FALLBACK_CAP_KM, annual_means_full
from gridpanel.plans.pipeline import PipelineConfig, run_pipeline, temperature
from gridpanel.session import scratch_path
from gridpanel.sources import fixtures as fx
from gridpanel.sources.tables import landed_partition_report, read_co2_csv, read_parquet_dir

SF = "/root/testdata/sf0.001"
# real names with their ISO3 codes, one per nation key
COUNTRIES = [("France", "FRA"), ("Germany", "DEU"), ("Spain", "ESP"), ("Italy", "ITA"), ("Portugal", "PRT"),
             ("Norway", "NOR"), ("Sweden", "SWE"), ("Finland", "FIN"), ("Poland", "POL"), ("Austria", "AUT"),
             ("Greece", "GRC"), ("Egypt", "EGY"), ("Kenya", "KEN"), ("Chile", "CHL"), ("Peru", "PER"),
             ("Brazil", "BRA"), ("Mexico", "MEX"), ("Canada", "CAN"), ("Japan", "JPN"), ("India", "IND"),
             ("China", "CHN"), ("Nepal", "NPL"), ("Ghana", "GHA"), ("Mali", "MLI"), ("Chad", "TCD")]


def land_inputs(spark, root):
    grid = fx.grid_facts(spark, SF).withColumn("year", F.year("valid_time"))
    grid.write.partitionBy("year").parquet(f"{root}/grid")
    feats = []
    for r in fx.regions_box(spark, SF).orderBy("region_id").collect():   # 25 rows of test fixture
        ring = [[r.lon0, r.lat0], [r.lon1, r.lat0], [r.lon1, r.lat1], [r.lon0, r.lat1], [r.lon0, r.lat0]]
        feats.append({"type": "Feature", "properties": {"name": COUNTRIES[r.region_id][0]},
                      "geometry": {"type": "Polygon", "coordinates": [ring]}})
    spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": feats}),)], "v string") \
        .coalesce(1).write.text(f"{root}/countries.geojson")
    codes = spark.createDataFrame([(f"N{k:02d}", c) for k, (_, c) in enumerate(COUNTRIES)], "syn string, iso string")
    co2 = (fx.co2_raw(spark, SF).join(codes, F.upper("iso_code") == codes.syn, "left")
           .withColumn("iso_code", F.coalesce(F.lower("iso"), F.col("iso_code"))).drop("syn", "iso")
           .withColumn("country", F.lit("x")))
    co2.coalesce(1).write.option("header", True).csv(f"{root}/co2.csv")
    wb = (fx.indicators_wide(spark, SF).join(codes, F.col("economy") == codes.syn)
          .withColumn("economy", F.col("iso")).drop("syn", "iso"))
    wb.write.parquet(f"{root}/wb")


def test_pipeline_end_to_end(spark):
    root = scratch_path(spark, "pipeline")
    land_inputs(spark, root)
    rep = landed_partition_report(spark, f"{root}/grid", ["valid_time", "latitude", "longitude", "t2m"])
    got = {r["year"]: (r["n_months"], r["valid"]) for r in rep.collect()}
    assert {y: v for y, (_, v) in got.items()} == {**{y: True for y in range(1995, 2001)}, 2001: False}
    assert got[2001][0] == 11          # ship dates end in November 2001
    cfg = PipelineConfig(years="1995-2001", co2_start=1995, co2_end=None, buffer_m=0.0,
                         cap_km=FALLBACK_CAP_KM, grid=fx.fixture_grid())
    out = f"{root}/out"
    res = run_pipeline(spark, f"{root}/grid", f"{root}/countries.geojson", f"{root}/co2.csv", f"{root}/wb", out, cfg)
    # the published table equals the registered full query, names mapped back
    names = spark.createDataFrame([(f"NATION_{k}", n) for k, (n, _) in enumerate(COUNTRIES)], "syn string, name string")
    expect = (annual_means_full(spark, SF).join(names, F.col("country") == names.syn)
              .select(F.col("name").alias("country"), "year", "temp_c"))
    pub = spark.read.option("header", True).schema("country string, year int, temp_c double") \
        .csv(f"{out}/outputs/annual_country_temp.csv").select("country", "year", F.round("temp_c", 6).alias("temp_c"))
    assert pub.exceptAll(expect).count() == 0 and expect.exceptAll(pub).count() == 0
    assert res.publish.n_rows == expect.count()
    assert res.enriched_rows > 0
    enriched = spark.read.option("header", True).csv(f"{out}/outputs/annual_country_enriched.csv")
    assert enriched.count() == res.enriched_rows
    assert set(enriched.columns) >= {"iso3", "year", "country", "temp_c", "co2_mt", "gdp_pc_const_usd"}
    # the audit CSV and the preview exist; flat and nested layouts both read
    audit = spark.read.option("header", True).csv(f"{out}/annual_temp/fallback_audit.csv")
    assert audit.count() == 5 * 7     # a row for each region and processed year
    assert read_parquet_dir(spark, f"{out}/owid_co2").count() > 0


def test_axes_of_a_year_whose_first_step_holds_a_part_of_the_grid(spark):
    root = scratch_path(spark, "part-grid")
    months = spark.sql("select explode(array(1, 2)) as m, explode(sequence(0, 3)) as i").crossJoin(
        spark.range(8).withColumnRenamed("id", "j")).where("m = 2 or j < 4")
    facts = months.selectExpr("make_timestamp(2000, m, 1, 0, 0, 0) as valid_time", "cast(10 * i as double) as latitude",
                              "cast(10 * j as double) as longitude", "273.15 + m as t2m", "2000 as year")
    facts.write.partitionBy("year").parquet(f"{root}/grid")
    feats = [{"type": "Feature", "properties": {"name": name}, "geometry": {"type": "Polygon", "coordinates": [
        [[x, 5], [x + 20, 5], [x + 20, 25], [x, 25], [x, 5]]]}} for name, x in (("Near", 5), ("Far", 55))]
    spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": feats}),)], "v string") \
        .coalesce(1).write.text(f"{root}/countries.geojson")
    cfg = PipelineConfig(years="2000", buffer_m=0.0, cap_km=1.0)
    got = temperature(spark, f"{root}/grid", f"{root}/countries.geojson", f"{root}/out", cfg)
    assert {r.country: round(r.temp_c, 6) for r in got.collect()} == {"Near": 1.5, "Far": 2.0}


def test_co2_csv_nulls(spark):
    path = scratch_path(spark, "co2") + ".csv"
    spark.createDataFrame([("fra", "France", "2000", "NaN", "", "NA")],
                          "iso_code string, country string, year string, co2 string, co2_per_capita string, x string") \
        .coalesce(1).write.option("header", True).csv(path)
    r = read_co2_csv(spark, path).collect()[0]
    assert r["year"] == 2000 and r["co2"] is None and r["co2_per_capita"] is None


def test_grid_years_missing_error_and_warn(spark):
    import pytest

    from gridpanel.sources.grid import read_grid_years

    root = scratch_path(spark, "gridyears")
    fx.grid_facts(spark, SF).withColumn("year", F.year("valid_time")).where("year in (1996, 1997)") \
        .write.partitionBy("year").parquet(root)
    kw = dict(value="t2m", lat="latitude", lon="longitude")
    with pytest.raises(FileNotFoundError, match=r"\[1995, 1998\]"):
        read_grid_years(spark, root, [1995, 1996, 1997, 1998], **kw)
    facts, missing = read_grid_years(spark, root, [1995, 1996], on_missing="warn", **kw)
    assert missing == [1995] and sorted(r[0] for r in facts.select("year").distinct().collect()) == [1996]
    with pytest.raises(FileNotFoundError):
        read_grid_years(spark, root, [1990], on_missing="warn", **kw)
