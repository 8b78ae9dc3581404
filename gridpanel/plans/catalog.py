"""Registry of the queries exposed to the driver: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import fixtures as fx
from ..session import table as _table
from ..sources.grid import GridSpec, normalize_facts

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# -- shared fixture plumbing -----------------------------------------------------

def facts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.grid_facts(spark, sf_dir)
    return normalize_facts(raw, value="t2m", lat="latitude", lon="longitude", time="valid_time")


def grid_of(facts: DataFrame | None = None) -> GridSpec:
    """The derived grid's axes (``GridSpec.from_facts`` gives the same, see tests)."""
    return fx.fixture_grid()


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


# -- climate: cover + two-level means ----------------------------------------------

@query("annual_means_box")
def annual_means_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .annual import direct_annual_means

    facts = facts_of(spark, sf_dir)
    regions = fx.box_polygons(fx.regions_box(spark, sf_dir))
    out = direct_annual_means(facts, regions, grid_of(facts))
    return out.select("country", "year", r6("temp_c"))


# -- ingest: CO2 and indicator panels -------------------------------------------------

CO2_START_YEAR = 1996


def co2_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .panels import clean_co2

    return clean_co2(fx.co2_raw(spark, sf_dir), CO2_START_YEAR, None)


def wb_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .panels import tidy_indicators

    return tidy_indicators(fx.indicators_wide(spark, sf_dir))


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


@query("annual_means_runs")
def annual_means_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full annual job over runs of columns instead of cells."""
    from .annual import annual_means_over_runs

    facts = facts_of(spark, sf_dir)
    out, _ = annual_means_over_runs(facts, _boxes(spark, sf_dir), grid_of(facts), buffer_m=0.0, cap_km=FALLBACK_CAP_KM)
    return out.select("country", "year", r6("temp_c"))


@query("tile_means")
def tile_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual means from 16 x 16 array tiles of the monthly grid."""
    from ..operators.tiles import tile_facts
    from .annual import annual_means_over_tiles

    grid = grid_of()
    out = annual_means_over_tiles(tile_facts(facts_of(spark, sf_dir), grid), _boxes(spark, sf_dir), grid)
    return out.select("country", "year", r6("temp_c"))


@query("co2_clean")
def co2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(co2_panel(spark, sf_dir))


@query("wb_melt")
def wb_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .panels import melt_indicators

    return _round_doubles(melt_indicators(fx.indicators_wide(spark, sf_dir)))


@query("wb_tidy")
def wb_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_doubles(wb_panel(spark, sf_dir))


@query("wb_first_rows")
def wb_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicator panel where files hold three rows of each (economy, series): of every
    cell the first value in the files counts."""
    from ..session import scratch_path
    from ..sources.tables import read_indicators
    from .panels import tidy_indicators

    path = scratch_path(spark, "wb-repeated")
    wide = fx.indicators_wide(spark, sf_dir)
    years = [c for c in wide.columns if c.startswith("YR")]
    takes = F.array(*[F.struct(F.lit(k).alias("take"), F.lit(d).alias("times")) for k, d in enumerate((2.0, 1.0, 3.0))])
    rows = wide.withColumn("t", F.explode(takes))
    # the first take has no values for even years
    cells = [F.when((F.col("t.take") > 0) | F.lit(int(c[2:]) % 2 == 1), F.col(c) * F.col("t.times")).alias(c) for c in years]
    (rows.repartitionByRange(3, "t.take").sortWithinPartitions("t.take", "economy", "series")
     .select("economy", "series", *cells).write.parquet(path))
    return _round_doubles(tidy_indicators(read_indicators(spark, path, ordered=True)))


@query("keep_iso3_year")
def keep_iso3_year_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level rows with mixed-quality codes; first order per (iso3, year)."""
    from ..operators.clean import keep_iso3_year

    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    code = (F.when(F.col("o_orderkey") % 50 == 0, F.lit("OWID_WRL"))
            .when(F.col("o_orderkey") % 50 == 1, F.lit("eu"))
            .when(F.col("o_orderkey") % 50 == 2, F.lit(None).cast("string"))
            .when(F.col("o_orderkey") % 2 == 0, F.lower(fx.iso_code(F.col("c_nationkey"))))
            .otherwise(fx.iso_code(F.col("c_nationkey"))))
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        code.alias("iso3"), F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    return keep_iso3_year(rows, ["o_orderkey"])


def temp_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship means with synthetic codes ``Nkk`` (shared with the other panels)."""
    from .annual import direct_annual_means

    facts = facts_of(spark, sf_dir)
    regions = fx.box_polygons(fx.regions_box(spark, sf_dir))
    out = direct_annual_means(facts, regions, grid_of(facts))
    return out.select(fx.iso_code(F.col("region_id")).alias("iso3"), "year", "country", "temp_c")


@query("align_years")
def align_years_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .panels import align_years, prepare_panels

    aligned = align_years(prepare_panels(temp_panel(spark, sf_dir), co2_panel(spark, sf_dir),
                                         wb_panel(spark, sf_dir)))
    parts = [p.agg(F.lit(name).alias("panel"), F.count("*").alias("n_rows"),
                   F.min("year").alias("min_year"), F.max("year").alias("max_year"))
             for name, p in zip(["temperature", "co2", "indicators"], aligned)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("enrich")
def enrich_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .panels import enrich

    out = enrich(temp_panel(spark, sf_dir), co2_panel(spark, sf_dir), wb_panel(spark, sf_dir))
    return _round_doubles(out)


# -- names: text fold and the iso3 cascade ----------------------------------------------

# Fixture names per nation key: exercises every step of the cascade.
NATION_NAMES = [
    "Türkiye", "Cote d'Ivoire", "Côte d'Ivoire", " Kosovo ", "CONGO",
    "Dhekelia Sovereign Base Area", "Atlantis", "DE", "republic of india", "Germany",
    "France", "Russia", "Viet Nam", "Bolivia", "Turkey",
    "Brunei", "Åland Islands", "Aland", "Curaçao", " Curacao",
    "São Tomé and Príncipe", "Korea, Republic of", "United States", "usa", "840",
]


def customer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame(list(enumerate(NATION_NAMES)), "nationkey int, country string")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.join(F.broadcast(names), c.c_nationkey == names.nationkey).select("c_custkey", "country")


@query("iso3_lookup")
def iso3_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.names import add_iso3

    mapped = add_iso3(customer_countries(spark, sf_dir), "country", "iso3")
    return mapped.groupBy("country", "iso3").agg(F.count("*").alias("n_customers"))


@query("iso3_unmapped")
def iso3_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.names import add_iso3, unmapped_names

    return unmapped_names(add_iso3(customer_countries(spark, sf_dir), "country", "iso3"))


@query("norm_text")
def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import fold_ascii

    d = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", fold_ascii(F.col("text")).alias("norm"))


# -- climate: fallback, audit, shapes --------------------------------------------------

FALLBACK_CAP_KM = 230.0


def _boxes(spark, sf_dir):
    return fx.box_polygons(fx.regions_box(spark, sf_dir))


@query("unweighted_means")
def unweighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .annual import direct_annual_means

    facts = facts_of(spark, sf_dir)
    out = direct_annual_means(facts, _boxes(spark, sf_dir), grid_of(facts), weighted=False)
    return out.select("country", "year", r6("temp_c"))


@query("annual_means_full")
def annual_means_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .annual import annual_means

    facts = facts_of(spark, sf_dir)
    out, _ = annual_means(facts, _boxes(spark, sf_dir), grid_of(facts), buffer_m=0.0,
                          cap_km=FALLBACK_CAP_KM)
    return out.select("country", "year", r6("temp_c"))


@query("fallback_audit")
def fallback_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .annual import annual_means

    facts = facts_of(spark, sf_dir)
    _, audit = annual_means(facts, _boxes(spark, sf_dir), grid_of(facts), buffer_m=0.0,
                            cap_km=FALLBACK_CAP_KM)
    return audit.select("country", "status", r6("min_km"), "near_lat", "near_lon")


@query("fallback_series")
def fallback_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual means of the regions that were filled from their nearest node."""
    from .annual import fallback_means

    out = fallback_means(facts_of(spark, sf_dir), _boxes(spark, sf_dir), grid_of(), buffer_m=0.0, cap_km=FALLBACK_CAP_KM)
    return out.select("country", "year", r6("temp_c"))


@query("fallback_by_year")
def fallback_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual means where one year's grid ends at the equator: regions south of it fall
    back in that year alone."""
    from .annual import annual_means_by_extent

    facts = facts_of(spark, sf_dir).where((F.col("year") != 1997) | (F.col("lat") >= 0))
    out, _ = annual_means_by_extent(facts, _boxes(spark, sf_dir), buffer_m=0.0, cap_km=FALLBACK_CAP_KM)
    return out.select("country", "year", r6("temp_c"))


@query("nearest_cell")
def nearest_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.nearest import nearest_node
    from ..operators.shapes import representative_point

    regions = fx.triangle_polygons(fx.customer_boxes(spark, sf_dir))
    pts = representative_point(regions).withColumnsRenamed({"rx": "plon", "ry": "plat"})
    near = nearest_node(pts, grid_of())
    return near.select("region_id", r6("min_km"), "near_lat", "near_lon",
                       (F.col("min_km") <= FALLBACK_CAP_KM).alias("within_cap"))


@query("cover_scanline")
def cover_scanline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.cover import scanline_cover
    from ..operators.geometry import region_edges

    g = grid_of()
    cov = scanline_cover(region_edges(fx.triangle_polygons(fx.customer_boxes(spark, sf_dir))), g)
    return cov.select("region_id", g.lat_of(F.col("ilat")).alias("lat"), g.lon_of(F.col("ilon")).alias("lon"))


COVER_BUFFER_M = 300000.0


@query("cover_buffered")
def cover_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.cover import buffered_cover
    from ..operators.geometry import region_edges

    g = grid_of()
    cov = buffered_cover(region_edges(fx.triangle_polygons(fx.customer_boxes(spark, sf_dir))), g, COVER_BUFFER_M)
    return cov.select("region_id", g.lat_of(F.col("ilat")).alias("lat"), g.lon_of(F.col("ilon")).alias("lon"))


@query("cover_overlap_counts")
def cover_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many grid nodes holding facts lie in 1, 2, ... boxes."""
    from ..operators.cover import scanline_cover
    from ..operators.geometry import region_edges
    from ..sources.grid import with_cell_keys

    g = grid_of()
    cov = scanline_cover(region_edges(_boxes(spark, sf_dir)), g)
    per_cell = cov.groupBy("ilat", "ilon").agg(F.count("*").alias("n_regions"))
    nodes = with_cell_keys(facts_of(spark, sf_dir), g).select("ilat", "ilon").distinct()
    return (per_cell.join(nodes, ["ilat", "ilon"]).groupBy("n_regions")
            .agg(F.count("*").alias("n_cells")))


@query("centroid")
def centroid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.shapes import centroid

    return centroid(fx.triangle_polygons(fx.customer_boxes(spark, sf_dir))).select("region_id", r6("cx"), r6("cy"))


@query("representative_point")
def representative_point_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.shapes import representative_point

    rp = representative_point(fx.triangle_polygons(fx.customer_boxes(spark, sf_dir)))
    return rp.select("region_id", r6("rx"), r6("ry"))


@query("project_metres")
def project_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.geodesy import ease_x, ease_y

    c = _table(spark, sf_dir, "customer").select("c_custkey")
    lon = (F.col("c_custkey") % 3600).cast("double") / 10.0 - 180.0
    lat = (F.col("c_custkey") % 1799).cast("double") / 10.0 - 89.9
    return c.select("c_custkey", F.round(ease_x(lon), 3).alias("x"), F.round(ease_y(lat), 3).alias("y"))


@query("haversine_pairs")
def haversine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Great-circle distance between the supplier's and the customer's nation
    centres for every line item, averaged per nation pair."""
    from ..functions.geodesy import haversine_km

    boxes = fx.regions_box(spark, sf_dir).select("region_id", "clon", "clat")
    sb = boxes.select(F.col("region_id").alias("s_nationkey"), F.col("clon").alias("slon"), F.col("clat").alias("slat"))
    cb = boxes.select(F.col("region_id").alias("c_nationkey"), F.col("clon").alias("clon"), F.col("clat").alias("clat"))
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # lines per pair first, then one distance per pair
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(s, li.l_suppkey == s.s_suppkey).groupBy("s_nationkey", "c_nationkey").agg(F.count("*").alias("n_lines"))
         .join(sb, "s_nationkey").join(cb, "c_nationkey"))
    km = haversine_km(F.col("slat"), F.col("slon"), F.col("clat"), F.col("clon"))
    return j.select("s_nationkey", "c_nationkey", "n_lines", F.round(km, 6).alias("avg_km"))


@query("grid_mesh")
def grid_mesh_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the grid whose axes are derived from the facts."""
    from ..operators.reshape import grid_mesh

    g = GridSpec.from_facts(facts_of(spark, sf_dir))
    return grid_mesh(spark, g.nlat, g.nlon, g.lat_of, g.lon_of).select("lat", "lon")


@query("array_flatten")
def array_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding vectors as 8-wide 2-d arrays, flattened with two posexplodes."""
    from ..sources.grid import array_grid_to_long, as_rows

    e = _table(spark, sf_dir, "embeddings").select("vec_id", as_rows(F.col("embedding"), 8).alias("rows"))
    g = array_grid_to_long(e, values="rows", time="vec_id")
    return g.select(F.col("time").alias("vec_id"), (F.col("lat_pos") * 8 + F.col("lon_pos")).alias("pos"),
                    F.col("lat_pos").alias("r"), F.col("lon_pos").alias("c"), F.col("v").alias("value"))


# -- publish: partitions in, one CSV out ----------------------------------------------

PUBLISH_MIN_YEAR, PUBLISH_MAX_YEAR = 1996, 2000


def _landed_annual(spark: SparkSession, sf_dir: str) -> str:
    """Write the flagship result as year partitions under the shared checkpoint
    folder and return the path (the publish job's input)."""
    from ..session import scratch_path
    from ..sinks.files import write_year_partitions

    path = scratch_path(spark, "annual_temp")
    write_year_partitions(annual_means_box(spark, sf_dir), path)
    return path


@query("parquet_roundtrip")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_landed_annual(spark, sf_dir)).select("country", "year", "temp_c")


@query("path_year")
def path_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.years import year_from_path

    df = spark.read.parquet(_landed_annual(spark, sf_dir))
    return (df.select(year_from_path(F.col("_metadata.file_path")).alias("path_year"))
            .groupBy("path_year").agg(F.count("*").alias("n_rows")))


@query("publish_rows")
def publish_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .publish import load_partitions, publish_rows

    df = load_partitions(spark, _landed_annual(spark, sf_dir), PUBLISH_MIN_YEAR, PUBLISH_MAX_YEAR, ordered=True)
    return publish_rows(df)


@query("publish_first_rows")
def publish_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with several rows of a (country, year): the first row in the files is published,
    which is neither the coldest nor the warmest."""
    from ..session import scratch_path
    from .publish import load_partitions, publish_rows

    path = scratch_path(spark, "repeated")
    takes = F.array(*[F.struct(F.lit(k).alias("take"), F.lit(d).alias("more")) for k, d in enumerate((1.0, -2.0, 3.0, 0.5))])
    rows = annual_means_box(spark, sf_dir).select("country", "year", "temp_c", F.explode(takes).alias("t"))
    # later takes in later files of the same folder
    (rows.repartitionByRange(4, "t.take").sortWithinPartitions("year", "t.take", F.desc("country"))
     .select("country", "year", (F.col("temp_c") + F.col("t.more")).alias("temp_c"))
     .write.partitionBy("year").parquet(path))
    df = publish_rows(load_partitions(spark, path, PUBLISH_MIN_YEAR, PUBLISH_MAX_YEAR, ordered=True))
    return df.select("country", "year", r6("temp_c"))


@query("partition_drift")
def partition_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with the files of a landed table: in every third year one of two files
    holds the temperature as text, in the next one a further column and no country."""
    from ..session import scratch_path
    from ..sources.footers import partition_files, partition_problems
    from .publish import REQUIRED

    path = scratch_path(spark, "drift")
    rows = annual_means_box(spark, sf_dir)
    rows.write.partitionBy("year").parquet(path)
    (rows.where(F.col("year") % 3 == 0).withColumn("temp_c", F.col("temp_c").cast("string")).coalesce(1)
     .write.mode("append").partitionBy("year").parquet(path))
    (rows.where(F.col("year") % 3 == 1).select("year", "temp_c", F.lit("x").alias("note")).coalesce(1)
     .write.mode("append").partitionBy("year").parquet(path))
    return partition_problems(partition_files(spark, path, REQUIRED))


@query("publish_stats")
def publish_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import scratch_path
    from .publish import publish

    out = scratch_path(spark, "published") + ".csv"
    s = publish(spark, _landed_annual(spark, sf_dir), out, PUBLISH_MIN_YEAR, PUBLISH_MAX_YEAR,
                success_marker=out + "._SUCCESS")
    from .publish import publish_stats
    from ..schemas import ANNUAL_TEMP

    published = spark.read.option("header", True).schema(ANNUAL_TEMP).csv(out)
    assert s.n_rows == published.count()
    return publish_stats(published)


# -- quality reports ---------------------------------------------------------------------

def _full(spark, sf_dir, facts=None):
    """The full annual job: (annual, audit)."""
    from .annual import annual_means

    facts = facts if facts is not None else facts_of(spark, sf_dir)
    return annual_means(facts, _boxes(spark, sf_dir), grid_of(facts), buffer_m=0.0, cap_km=FALLBACK_CAP_KM)


def _latest(spark, sf_dir):
    """The annual rows of the latest year, from the facts of that year alone; written to
    the checkpoint folder once."""
    facts = facts_of(spark, sf_dir)
    latest = facts.where(F.col("v").isNotNull()).select(F.max("year")).first()[0]
    annual, _ = _full(spark, sf_dir, facts.where(F.col("year") == latest))
    return annual.checkpoint()


@query("geom_quality")
def geom_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.geometry import clean_regions
    from ..operators.quality import geometry_counts

    raw = fx.customer_geometries(spark, sf_dir)
    return geometry_counts(raw, "raw").unionByName(geometry_counts(clean_regions(raw), "clean"))


@query("geom_sample_names")
def geom_sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five names of the cleaned polygon table in region order (head-n)."""
    from ..operators.geometry import clean_regions

    return (clean_regions(fx.customer_geometries(spark, sf_dir)).orderBy("region_id").limit(5)
            .select("region_id", "name"))


@query("temp_outliers")
def temp_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly regional means outside the plausible range, counted with the range seen."""
    from ..operators.quality import out_of_range_flag
    from ..operators.spatial_agg import regional_monthly
    from .annual import region_cover
    from ..sources.grid import with_cell_keys

    g = grid_of()
    cov = region_cover(_boxes(spark, sf_dir), g)
    m = regional_monthly(with_cell_keys(facts_of(spark, sf_dir), g), cov).withColumnRenamed("mt", "temp_c")
    return m.agg(F.count("*").alias("n_rows"),
                 F.count_if(out_of_range_flag(F.col("temp_c"))).alias("n_out_of_range"),
                 F.round(F.min("temp_c"), 6).alias("min_temp_c"), F.round(F.max("temp_c"), 6).alias("max_temp_c"))


@query("latest_stats")
def latest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import latest_year_stats

    s = latest_year_stats(_latest(spark, sf_dir))
    return s.select("year", "n_rows", r6("mean"), r6("min"), r6("max"), r6("std"))


@query("coverage_report")
def coverage_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.quality import coverage_report

    # read several times (scalar subqueries): written once to the shared folder
    annual, audit = (d.checkpoint() for d in _full(spark, sf_dir))
    boxes, landed = fx.regions_box(spark, sf_dir), facts_of(spark, sf_dir).select("year").distinct()
    return coverage_report(boxes, annual, audit, list(range(1996, 2004)), landed, _boxes(spark, sf_dir))


@query("top_regions")
def top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five warmest countries of the latest year (a top-k report)."""
    return (_latest(spark, sf_dir).orderBy(F.col("temp_c").desc_nulls_last(), F.col("country")).limit(5)
            .select("country", "year", r6("temp_c")))


@query("sample_latest")
def sample_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reproducible sample of five rows of the latest year: order by the MD5 of the
    key (a fixed hash that SQL engines share), then the key."""
    return (_latest(spark, sf_dir).orderBy(F.md5("country"), "country").limit(5)
            .select("country", "year", r6("temp_c")))


# -- year sets ---------------------------------------------------------------------------

@query("year_spec_filter")
def year_spec_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.years import years_df

    o = _table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    wanted = years_df(spark, "1996,1998,2000,1998")
    return o.join(F.broadcast(wanted), "year", "left_semi").groupBy("year").agg(F.count("*").alias("n_orders"))


@query("years_to_load")
def years_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested years with no landed data yet (the incremental plan)."""
    from ..functions.years import years_df, years_missing

    landed = _table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return years_missing(years_df(spark, "1990-2005"), landed)


@query("years_to_reload")
def years_to_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested years that are not landed, or landed with less than twelve months."""
    from ..functions.years import years_df, years_missing
    from ..session import scratch_path
    from ..sinks.files import write_year_partitions
    from ..sources.tables import landed_partition_report

    path = scratch_path(spark, "grid")
    write_year_partitions(fx.grid_facts(spark, sf_dir).withColumn("year", F.year("valid_time")), path)
    report = landed_partition_report(spark, path, ["valid_time", "latitude", "longitude", "t2m"])
    return years_missing(years_df(spark, "1994-2002"), report.where("valid"))


@query("years_outside")
def years_outside_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.years import years_df, years_outside

    return years_outside(annual_means_box(spark, sf_dir), years_df(spark, "1996-1999"))


ANNUAL_BUFFER_M = 200000.0


@query("annual_means_buffered")
def annual_means_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full annual job with a 200 km buffer: some tiny boxes are now reached by
    the buffer and need no fallback."""
    from .annual import annual_means

    facts = facts_of(spark, sf_dir)
    out, _ = annual_means(facts, _boxes(spark, sf_dir), grid_of(facts), buffer_m=ANNUAL_BUFFER_M,
                          cap_km=FALLBACK_CAP_KM)
    return out.select("country", "year", r6("temp_c"))


# -- the readers and sinks on landed files -----------------------------------------------

@query("co2_csv_scan")
def co2_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CO2 panel from a landed CSV with gaps written as NA and NaN."""
    from ..session import scratch_path
    from ..sources.tables import read_co2_csv
    from .panels import clean_co2

    path = scratch_path(spark, "co2-csv")
    raw = fx.co2_raw(spark, sf_dir)
    gap = F.when(F.col("year") == 1996, "NA").when(F.col("year") == 1997, "NaN").otherwise(F.col("co2").cast("string"))
    raw.withColumn("co2", gap).write.option("header", True).csv(path)
    return _round_doubles(clean_co2(read_co2_csv(spark, path), CO2_START_YEAR, None))


@query("wb_dirty_tidy")
def wb_dirty_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicator panel from a landed CSV whose empty cells are ``..`` or NaN."""
    from ..session import scratch_path
    from ..sources.tables import read_indicators
    from .panels import tidy_indicators

    path = scratch_path(spark, "wb-csv")
    wide = fx.indicators_wide(spark, sf_dir)
    years = [c for c in wide.columns if c.startswith("YR")]
    dirty = wide.select("economy", "series", *[
        F.coalesce(F.col(c).cast("string"), F.lit(".." if i % 2 else "NaN")).alias(c) for i, c in enumerate(years)])
    dirty.write.option("header", True).csv(path)
    return _round_doubles(tidy_indicators(read_indicators(spark, path, "csv")))


@query("geojson_regions")
def geojson_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions read from a folder of two GeoJSON files: unique ids, names and corners."""
    from ..session import scratch_path
    from ..sources.polygons import read_geojson_features, regions_from_features

    path = scratch_path(spark, "geojson")
    b = fx.regions_box(spark, sf_dir)
    corners = F.array(*[F.array(F.col(x), F.col(y)) for x, y in (
        ("lon0", "lat0"), ("lon1", "lat0"), ("lon1", "lat1"), ("lon0", "lat1"), ("lon0", "lat0"))])
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("name")).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), F.array(corners).alias("coordinates")).alias("geometry"))
    half = (F.col("region_id") % 2).alias("half")
    doc = (b.groupBy(half).agg(F.sort_array(F.collect_list(F.struct("region_id", feature.alias("f")))).alias("fs"))
           .select("half", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                              F.transform("fs", lambda x: x["f"]).alias("features"))).alias("value")))
    for k in (0, 1):
        doc.where(F.col("half") == k).select("value").coalesce(1).write.text(f"{path}/file{k}")
    feats = read_geojson_features(spark, f"{path}/file*")
    regions, _ = regions_from_features(feats, "name")
    ring = F.col("parts")[0][0]
    return regions.select("region_id", "name", F.size(ring).cast("long").alias("n_points"),
                          F.array_min(F.transform(ring, lambda p: p["lon"])).alias("lon0"),
                          F.array_max(F.transform(ring, lambda p: p["lat"])).alias("lat1"))


@query("dissolved_means")
def dissolved_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual means where the boxes of all nations of a region share its name."""
    from .annual import direct_annual_means

    boxes = fx.box_polygons(fx.regions_box(spark, sf_dir))
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    named = (boxes.drop("name").join(n, boxes.region_id == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select("region_id", F.col("r_name").alias("name"), "parts"))
    out = direct_annual_means(facts_of(spark, sf_dir), named, grid_of())
    return out.select("country", "year", r6("temp_c"))


@query("grid_years_scan")
def grid_years_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per year of a landed grid, read for years of which some are missing."""
    from ..session import scratch_path
    from ..sinks.files import write_year_partitions
    from ..sources.grid import read_grid_years

    path = scratch_path(spark, "grid")
    write_year_partitions(fx.grid_facts(spark, sf_dir).withColumn("year", F.year("valid_time")), path)
    facts, missing = read_grid_years(spark, path, [1990, 1996, 1998, 2030], on_missing="warn")
    assert missing == [1990, 2030]
    return facts.groupBy("year").agg(F.count("*").alias("n_rows"), F.count("v").alias("n_values"))


@query("publish_csv_lines")
def publish_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line number and values of the published CSV (its header is line 0)."""
    from ..operators.source_order import SOURCE_ORDER, with_line_order
    from ..schemas import ANNUAL_TEMP
    from ..session import scratch_path
    from .publish import publish

    out = scratch_path(spark, "published") + ".csv"
    publish(spark, _landed_annual(spark, sf_dir), out, PUBLISH_MIN_YEAR, PUBLISH_MAX_YEAR)
    lines = with_line_order(spark.read.option("header", True).schema(ANNUAL_TEMP).csv(out))
    # a published table is country x year: one task numbers its lines
    number = F.row_number().over(Window.orderBy(SOURCE_ORDER))
    return lines.select(number.alias("line_no"), "country", "year", r6("temp_c"))


BAND = (0.0, 30.0)


@query("regions_in_band")
def regions_in_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of a polygon table that reach into a band of latitudes."""
    from ..session import scratch_path
    from ..sources.polygons import read_region_table, write_region_table

    path = scratch_path(spark, "regions")
    write_region_table(fx.triangle_polygons(fx.customer_boxes(spark, sf_dir)), path)
    found = read_region_table(spark, path, *BAND)
    return found.select("region_id", "name", F.size(F.col("parts")[0][0]).cast("long").alias("n_points"))
