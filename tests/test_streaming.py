"""Incremental by-year job: new years are added, old partitions are kept."""

from pyspark.sql import functions as F

from gridpanel.plans.annual import annual_means
from gridpanel.plans.catalog import FALLBACK_CAP_KM, facts_of
from gridpanel.session import scratch_path
from gridpanel.sources.fixtures import box_polygons, fixture_grid, grid_facts, regions_box
from gridpanel.sources.grid import normalize_facts
from gridpanel.streaming.incremental import annual_year_job, start_incremental

SF = "/root/testdata/sf0.001"


def test_incremental_years(spark):
    raw = grid_facts(spark, SF).withColumn("year", F.year("valid_time"))
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "out", "ckpt"))
    regions = box_polygons(regions_box(spark, SF))
    grid = fixture_grid()

    job = annual_year_job(regions, grid, cap_km=FALLBACK_CAP_KM, time="valid_time")

    raw.where(F.col("year") <= 1997).write.partitionBy("year").parquet(landing)
    start_incremental(spark, landing, raw.schema, job, out, ckpt).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(out).select("year").distinct().collect()) == [1995, 1996, 1997]

    raw.where(F.col("year") > 1997).write.mode("append").partitionBy("year").parquet(landing)
    start_incremental(spark, landing, raw.schema, job, out, ckpt).awaitTermination()
    got = spark.read.parquet(out).select("country", "year", "temp_c")
    expect, audit = annual_means(facts_of(spark, SF), regions, grid, buffer_m=0.0, cap_km=FALLBACK_CAP_KM)
    assert audit.where("status = 'fallback_used'").count() > 0
    got, expect = (d.select("country", "year", F.round("temp_c", 9).alias("temp_c")) for d in (got, expect))
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
