"""Pipeline inputs derived from the driver's tables.

The driver ships TPC-H-like tables, not climate data. These views derive grid
facts, region polygons, a raw CO2 table and a wide indicator table from them with
plain arithmetic, so that every query's work grows with the input tables. The
same derivations are spelled out in SQL in ``plans/oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INDICATORS
from ..session import table

GRID_NLAT = 37
GRID_NLON = 72
GRID_STEP = 5.0


def fixture_grid():
    """Axes of the derived grid, known by construction: latitude 90..-90 (stored
    north to south), longitude 0..355 (wrapped to -180..175)."""
    from .grid import GridSpec

    return GridSpec(lat0=-90.0, dlat=GRID_STEP, nlat=GRID_NLAT, lon0=-180.0, dlon=GRID_STEP,
                    nlon=GRID_NLON, lat_descending=True, src_lon0=0.0)


def grid_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-degree global grid facts from lineitem, Kelvin, some values NULL.

    Columns: ``valid_time, latitude, longitude, t2m`` (the source layout) plus the
    source positions ``lat_idx, lon_idx``.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    lat_idx = F.col("l_partkey") % GRID_NLAT
    lon_idx = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % GRID_NLON
    return li.select(
        F.date_trunc("month", "l_shipdate").alias("valid_time"),
        lat_idx.alias("lat_idx"),
        lon_idx.alias("lon_idx"),
        (F.lit(90.0) - F.lit(GRID_STEP) * lat_idx).cast("double").alias("latitude"),
        (F.lit(GRID_STEP) * lon_idx).cast("double").alias("longitude"),
        F.when(F.col("l_orderkey") % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(250.0) + F.col("l_quantity")).alias("t2m"),
    )


def regions_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 boxes from nation: 20 wide ones and 5 tiny ones (keys 0,5,10,15,20)."""
    n = table(spark, sf_dir, "nation")
    r = n.select(
        F.col("n_nationkey").alias("region_id"),
        F.col("n_name").alias("name"),
        F.expr("cast(-170 + 13.6 * n_nationkey as double)").alias("clon"),
        F.expr("cast(-58.7 + 5 * n_nationkey as double)").alias("clat"),
        F.expr("cast(case when n_nationkey % 5 = 0 then 0.4 else 9.0 end as double)").alias("half"),
    )
    return r.select(
        "region_id", "name",
        (F.col("clon") - F.col("half")).alias("lon0"), (F.col("clon") + F.col("half")).alias("lon1"),
        (F.col("clat") - F.col("half")).alias("lat0"), (F.col("clat") + F.col("half")).alias("lat1"),
        "clon", "clat",
    )


def _pt(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def box_polygons(boxes: DataFrame) -> DataFrame:
    """Boxes as polygon rows ``(region_id, name, parts)`` (one part, one ring)."""
    lon0, lon1, lat0, lat1 = (F.col(c) for c in ("lon0", "lon1", "lat0", "lat1"))
    ring = F.array(_pt(lon0, lat0), _pt(lon1, lat0), _pt(lon1, lat1), _pt(lon0, lat1), _pt(lon0, lat0))
    return boxes.select("region_id", "name", F.array(F.array(ring)).alias("parts"))


def triangle_polygons(boxes: DataFrame) -> DataFrame:
    """Triangles (lon0, lat0), (lon1, lat0), (clon, lat1) of each box."""
    lon0, lon1, lat0, lat1, clon = (F.col(c) for c in ("lon0", "lon1", "lat0", "lat1", "clon"))
    ring = F.array(_pt(lon0, lat0), _pt(lon1, lat0), _pt(clon, lat1), _pt(lon0, lat0))
    return boxes.select("region_id", "name", F.array(F.array(ring)).alias("parts"))


def iso_code(nationkey: Column) -> Column:
    """Synthetic three-letter code ``Nkk`` for a nation key."""
    return F.concat(F.lit("N"), F.lpad(nationkey.cast("string"), 2, "0"))


def co2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CO2-like table: mixed-quality codes (aggregates, short codes, nulls, lower case)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    code = (F.when(F.col("o_orderkey") % 50 == 0, F.lit("OWID_WRL"))
            .when(F.col("o_orderkey") % 50 == 1, F.lit("eu"))
            .when(F.col("o_orderkey") % 50 == 2, F.lit(None).cast("string"))
            .otherwise(F.lower(iso_code(F.col("c_nationkey")))))
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.groupBy(code.alias("iso_code"), F.year("o_orderdate").alias("year"))
            .agg((F.sum("o_totalprice") / 1e6).alias("co2"),
                 (F.avg("o_totalprice") / 1e5).alias("co2_per_capita"),
                 (F.max("o_totalprice") / 1e6).alias("share_global_co2"),
                 (F.min("o_totalprice") / 1e6).alias("consumption_co2")))


INDICATOR_YEARS = list(range(1995, 2002))


def indicators_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide indicator table ``economy, series, YR1995..YR2001`` from lineitem x supplier."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    codes = list(INDICATORS)
    series = F.when(F.col("l_linenumber") == 1, F.lit(codes[0]))
    for i, code in enumerate(codes[1:-1], start=2):
        series = series.when(F.col("l_linenumber") == i, F.lit(code))
    series = series.otherwise(F.lit(codes[-1]))
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    # a year without a column would be lost: fail instead
    yr = F.year("l_shipdate")
    yr = F.when(yr.isin(INDICATOR_YEARS) | yr.isNull(), yr).otherwise(F.raise_error(F.concat(
        F.lit("no indicator column for the year "), yr.cast("string"))))
    return (j.groupBy(iso_code(F.col("s_nationkey")).alias("economy"), series.alias("series"))
            .agg(*[F.avg(F.when(yr == y, F.col("l_extendedprice"))).alias(f"YR{y}")
                   for y in INDICATOR_YEARS]))


def customer_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box per customer (grows with the data): centre from the key, half-size
    3..7 degrees; offsets keep centres off the 5-degree grid's midlines."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    clon = (F.col("c_custkey") % 3597).cast("double") / 10.0 - 179.83
    clat = (F.col("c_custkey") % 1193).cast("double") / 10.0 - 59.67
    half = (F.lit(3) + F.col("c_custkey") % 5).cast("double")
    r = c.select(F.col("c_custkey").alias("region_id"), F.col("c_name").alias("name"),
                 clon.alias("clon"), clat.alias("clat"), half.alias("half"))
    return r.select(
        "region_id", "name",
        (F.col("clon") - F.col("half")).alias("lon0"), (F.col("clon") + F.col("half")).alias("lon1"),
        (F.col("clat") - F.col("half")).alias("lat0"), (F.col("clat") + F.col("half")).alias("lat1"),
        "clon", "clat",
    )


def customer_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer triangles with some NULL (key % 7 = 3) and empty (key % 7 = 5)
    geometries, for the geometry-cleaning checks."""
    tri = triangle_polygons(customer_boxes(spark, sf_dir))
    k = F.col("region_id") % 7
    empty = F.array().cast("array<array<array<struct<lon:double,lat:double>>>>")
    return tri.withColumn("parts", F.when(k == 3, F.lit(None).cast(
        "array<array<array<struct<lon:double,lat:double>>>>")).when(k == 5, empty).otherwise(F.col("parts")))
