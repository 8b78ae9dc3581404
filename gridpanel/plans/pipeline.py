"""The whole job chain on landed files: ingest -> temperature -> enrich -> publish.

Inputs are landed files (grid facts partitioned by year, polygons as GeoJSON or a
Parquet polygon table, a CO2 CSV, a wide indicator table); every output is
written under ``out_dir``. Each step is a DataFrame plan; the only values that
come back to the driver are one-row statistics.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.years import parse_year_spec
from ..operators.dedup import keep_first
from ..operators.geometry import clean_regions, dissolve_by_name
from ..operators.quality import require_rows
from ..sinks.files import write_csv_if_any, write_single_csv, write_year_partitions
from ..sources.grid import GridSpec, grids_by_year, read_grid_years
from ..sources.polygons import read_geojson_features, read_region_table, regions_from_features, write_region_table
from ..sources.tables import read_co2_csv, read_indicators, read_parquet_dir
from .annual import annual_means_by_extent
from .panels import clean_co2, enrich, tidy_indicators, unmapped_countries
from .publish import PublishStats, publish


@dataclass
class PipelineConfig:
    years: str = "2000-2023"
    co2_start: int | None = 2000
    co2_end: int | None = 2023
    buffer_m: float = 15000.0
    cap_km: float = 25.0
    weighted: bool = True
    use_representative_point: bool = True
    country_col: str | None = "name"
    grid: GridSpec | None = None
    grid_columns: dict = field(default_factory=lambda: {
        "value": "t2m", "lat": "latitude", "lon": "longitude", "time": None})


@dataclass
class PipelineResult:
    n_countries: int
    n_years: int
    enriched_rows: int
    enriched_min_year: int | None
    enriched_max_year: int | None
    publish: PublishStats | None


def load_regions(spark: SparkSession, path: str, country_col: str | None, table: str | None = None) -> DataFrame:
    """Polygons -> cleaned regions, one per name (name column must be non-NULL). GeoJSON is
    parsed once, into the polygon table ``table`` where that is given."""
    if path.endswith(".parquet") or not path.endswith((".json", ".geojson")):
        regions = spark.read.parquet(path).select("region_id", "name", "parts")
    else:
        # a configured name column must exist; None looks for a known one
        regions, _ = regions_from_features(read_geojson_features(spark, path), country_col)
        if table:
            write_region_table(regions, table)
            regions = read_region_table(spark, table)
    regions = clean_regions(regions)
    unnamed = regions.where(F.col("name").isNull()).count()
    if unnamed:
        warnings.warn(f"{path}: {unnamed} features without a name are left out", stacklevel=2)
        regions = regions.where(F.col("name").isNotNull())
    return dissolve_by_name(require_rows(regions, "polygon table after cleaning"))


def temperature(spark: SparkSession, grid_path: str, polygons: str, out_dir: str,
                cfg: PipelineConfig) -> DataFrame:
    years = parse_year_spec(cfg.years)
    facts, missing = read_grid_years(spark, grid_path, years, **cfg.grid_columns)
    regions = load_regions(spark, polygons, cfg.country_col, f"{out_dir}/polygons")
    # axes of each landed year from all its time steps (a step may hold a part of the grid)
    landed = sorted(set(years) - set(missing))
    grids = [(cfg.grid, landed)] if cfg.grid else grids_by_year(facts)
    annual, audit = annual_means_by_extent(facts, regions, cfg.buffer_m, cfg.cap_km, cfg.weighted,
                                           cfg.use_representative_point, grids)
    annual = annual.where(F.col("year").isin(years)).checkpoint()
    write_year_partitions(annual, f"{out_dir}/annual_temp")
    write_csv_if_any(audit, f"{out_dir}/annual_temp/fallback_audit.csv")
    preview = f"{out_dir}/preview/annual_country_temperature_preview_{min(years)}-{max(years)}.csv"
    write_single_csv(keep_first(annual, ["country", "year"], ["temp_c"]), preview, sort=["country", "year"])
    return annual


def run_pipeline(spark: SparkSession, grid_path: str, polygons: str, co2_csv: str, indicators: str,
                 out_dir: str, cfg: PipelineConfig | None = None, indicators_fmt: str = "parquet",
                 publish_csv: bool = True) -> PipelineResult:
    cfg = cfg or PipelineConfig()
    # ingest panels (K2: per-year partitions, NULL years dropped)
    co2 = clean_co2(read_co2_csv(spark, co2_csv), cfg.co2_start, cfg.co2_end)
    write_year_partitions(co2, f"{out_dir}/owid_co2")
    wb = tidy_indicators(read_indicators(spark, indicators, indicators_fmt, ordered=indicators_fmt in ("csv", "parquet")))
    write_year_partitions(wb, f"{out_dir}/worldbank")
    annual = temperature(spark, grid_path, polygons, out_dir, cfg)
    # enrich from what was written (the same files a separate run would read)
    era5 = read_parquet_dir(spark, f"{out_dir}/annual_temp")
    owid = read_parquet_dir(spark, f"{out_dir}/owid_co2")
    wbr = read_parquet_dir(spark, f"{out_dir}/worldbank")
    # row count and year range come from observe() on the written plan, so the
    # plan runs once
    obs = Observation("enriched")
    write_csv_if_any(unmapped_countries(era5), f"{out_dir}/outputs/unmapped_countries.csv")
    enriched = enrich(era5, owid, wbr).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.min("year").alias("y_min"), F.max("year").alias("y_max"))
    write_single_csv(enriched, f"{out_dir}/outputs/annual_country_enriched.csv", sort=["iso3", "year"])
    m = obs.get
    stats = annual.agg(F.count_distinct("country").alias("c"), F.count_distinct("year").alias("y")).first()
    pub = None
    if publish_csv:
        pub = publish(spark, f"{out_dir}/annual_temp", f"{out_dir}/outputs/annual_country_temp.csv",
                      success_marker=f"{out_dir}/outputs/_SUCCESS")
    return PipelineResult(stats["c"], stats["y"], m["rows"], m["y_min"], m["y_max"], pub)
