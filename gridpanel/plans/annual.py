"""Country-by-year mean temperature from gridded facts and region polygons.

Plan: facts (degC, NaN->NULL) get integer cell keys; region polygons become a
cell cover (containment, optionally buffered); the cover is joined to the facts
on the cell key (broadcast when its measured size allows, shuffle otherwise), and
a two-level aggregate gives (region, year) means. Regions without any cell get a
nearest-cell fallback (``operators/nearest.py``); direct results win over
fallback rows in the keep-first union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cover import buffered_cover
from ..operators.geometry import one_region_per_name, region_edges, region_names
from ..operators.joins import sized_broadcast
from ..operators.spatial_agg import regional_monthly, annual_from_monthly
from ..sources.grid import GridSpec, grids_by_year, with_cell_keys


def region_cover(regions: DataFrame, grid: GridSpec, buffer_m: float = 0.0) -> DataFrame:
    """``(region_id, ilat, ilon)`` for ``regions(region_id, name, parts)``."""
    return buffered_cover(region_edges(regions), grid, buffer_m)


def direct_annual_means(facts: DataFrame, regions: DataFrame, grid: GridSpec | None = None,
                        buffer_m: float = 0.0, weighted: bool = True,
                        cover: DataFrame | None = None) -> DataFrame:
    """``(region_id, country, year, temp_c)`` for regions with at least one cell.

    ``facts`` is the normalised long table ``(time, year, lat, lon, v)``.
    """
    grid = grid or GridSpec.from_facts(facts)
    regions = one_region_per_name(regions)
    cov = cover if cover is not None else region_cover(regions, grid, buffer_m)
    cov = sized_broadcast(cov)
    keyed = with_cell_keys(facts, grid)
    annual = annual_from_monthly(regional_monthly(keyed, cov, weighted))
    # the name dimension is one row per region; the planner's size estimate of
    # the region scan decides broadcast vs shuffle (autoBroadcastJoinThreshold)
    names = region_names(regions).withColumnRenamed("name", "country")
    return annual.join(names, "region_id").select(
        "region_id", "country", F.col("year").cast("int").alias("year"), "temp_c")


def cover_with_fallback(regions: DataFrame, grid: GridSpec, buffer_m: float, cap_km: float,
                        use_representative_point: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(cover, fallback cells, audit)`` of regions that have distinct names: the cover
    with ``priority`` 0, and the nearest nodes of regions without a cell with 1."""
    direct = region_cover(regions, grid, buffer_m).withColumn("priority", F.lit(0)).cache()
    fb_cells, audit = fallback_cells(regions, direct, grid, cap_km, use_representative_point)
    return direct, fb_cells.withColumn("priority", F.lit(1)), audit


def fallback_cells(regions: DataFrame, direct: DataFrame, grid: GridSpec, cap_km: float,
                   use_representative_point: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(cells, audit)`` for the regions without a row in the cover ``direct``."""
    from ..operators.nearest import fallback_plan
    from ..operators.shapes import centroid, representative_point

    missing = region_names(regions).join(direct.select("region_id").distinct(), "region_id", "left_anti")
    # only regions without a cell need a point
    lone = regions.join(missing.select("region_id"), "region_id", "left_semi")
    pts = (representative_point(lone).withColumnsRenamed({"rx": "plon", "ry": "plat"})
           if use_representative_point else
           centroid(lone).withColumnsRenamed({"cx": "plon", "cy": "plat"}))
    return fallback_plan(missing, pts, grid, cap_km)


def means_over_cover(facts: DataFrame, regions: DataFrame, grid: GridSpec, cover: DataFrame,
                     weighted: bool = True) -> DataFrame:
    """``(country, year, temp_c)`` over a cover with priorities: direct rows win."""
    # a region is either direct or fallback, so priority rides along as a key
    return _direct_wins(regional_monthly(with_cell_keys(facts, grid), sized_broadcast(cover), weighted, carry=["priority"]), regions)


def _direct_wins(monthly: DataFrame, regions: DataFrame) -> DataFrame:
    from ..operators.dedup import keep_first

    annual = annual_from_monthly(monthly, carry=["priority"])
    out = (annual.join(region_names(regions), "region_id")
           .select(F.col("name").alias("country"), F.col("year").cast("int").alias("year"),
                   F.col("temp_c").cast("double").alias("temp_c"), "priority"))
    return keep_first(out, ["country", "year"], ["priority"]).drop("priority")


def annual_means(facts: DataFrame, regions: DataFrame, grid: GridSpec | None = None,
                 buffer_m: float = 15000.0, cap_km: float = 25.0, weighted: bool = True,
                 use_representative_point: bool = True) -> tuple[DataFrame, DataFrame]:
    """Full job: ``(annual(country, year, temp_c), audit(country, status, min_km,
    near_lat, near_lon))``.

    * rows that share a name are one region (dissolved);
    * cover of every region (buffered containment), computed once and reused;
    * regions with no cell get their nearest node (capped) as a one-cell cover;
    * direct and fallback cells go through the same two-level aggregate (a
      one-cell weighted mean is the plain mean of that cell);
    * keep-first per (country, year) prefers direct rows over fallback rows.

    The audit has one row per region that needed a fallback (not one per year).
    """
    grid = grid or GridSpec.from_facts(facts)
    regions = one_region_per_name(regions)
    direct, fallback, audit = cover_with_fallback(regions, grid, buffer_m, cap_km, use_representative_point)
    out = means_over_cover(facts, regions, grid, direct.unionByName(fallback), weighted)
    return out, audit.drop("region_id")


def annual_means_over_runs(facts: DataFrame, regions: DataFrame, grid: GridSpec | None = None, buffer_m: float = 15000.0,
                           cap_km: float = 25.0, weighted: bool = True) -> tuple[DataFrame, DataFrame]:
    """``annual_means`` with the cover as runs of columns: facts meet the runs' ends alone."""
    from ..operators.runs import monthly_over_runs, runs_of, scanline_runs

    grid = grid or GridSpec.from_facts(facts)
    regions = one_region_per_name(regions)
    direct = (runs_of(region_cover(regions, grid, buffer_m)) if buffer_m and buffer_m > 0
              else scanline_runs(region_edges(regions), grid)).cache()
    cells, audit = fallback_cells(regions, direct, grid, cap_km)
    runs = direct.withColumn("priority", F.lit(0)).unionByName(runs_of(cells).withColumn("priority", F.lit(1)))
    return _direct_wins(monthly_over_runs(facts, grid, runs, weighted, carry=["priority"]), regions), audit.drop("region_id")


def annual_means_over_tiles(tiles: DataFrame, regions: DataFrame, grid: GridSpec, buffer_m: float = 0.0,
                            weighted: bool = True) -> DataFrame:
    """``(region_id, country, year, temp_c)`` from array tiles, for regions with a cell."""
    from ..operators.tiles import monthly_over_tiles, tile_weights

    regions = one_region_per_name(regions)
    weights = tile_weights(region_cover(regions, grid, buffer_m), grid, weighted)
    annual = annual_from_monthly(monthly_over_tiles(tiles, weights))
    return annual.join(region_names(regions).withColumnRenamed("name", "country"), "region_id").select(
        "region_id", "country", F.col("year").cast("int").alias("year"), "temp_c")


def fallback_means(facts: DataFrame, regions: DataFrame, grid: GridSpec, buffer_m: float = 15000.0,
                   cap_km: float = 25.0, use_representative_point: bool = True) -> DataFrame:
    """``(country, year, temp_c)`` of the regions filled from their nearest node alone:
    the facts are joined to the fallback cells and to nothing else."""
    regions = one_region_per_name(regions)
    _, fallback, _ = cover_with_fallback(regions, grid, buffer_m, cap_km, use_representative_point)
    return means_over_cover(facts, regions, grid, fallback)


def annual_means_by_extent(facts: DataFrame, regions: DataFrame, buffer_m: float = 15000.0, cap_km: float = 25.0,
                           weighted: bool = True, use_representative_point: bool = True,
                           grids: list[tuple[GridSpec, list[int]]] | None = None) -> tuple[DataFrame, DataFrame]:
    """``annual_means`` for years whose grids differ: cover, missing set and fallback are
    decided for each extent, so a region outside of one year's grid gets its nearest node in
    that year alone. The audit has a row for each region and year."""
    regions = one_region_per_name(regions)
    annual = audit = None
    for grid, years in grids if grids is not None else grids_by_year(facts):
        own = facts.where(F.col("year").isin(years))
        a, b = annual_means(own, regions, grid, buffer_m, cap_km, weighted, use_representative_point)
        b = b.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))
        annual = a if annual is None else annual.unionByName(a)
        audit = b if audit is None else audit.unionByName(b)
    if annual is None:
        raise ValueError("cannot derive a grid from an empty fact table")
    return annual, audit
