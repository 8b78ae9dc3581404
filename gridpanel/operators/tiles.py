"""Regional means over array tiles, folded inside the row.

A tile is a block of a time step's grid as ``ARRAY<ARRAY<DOUBLE>>``, the form in which
chunked array stores keep grids. A region's weights are sparse rows (region, tile, list of
(row, column, weight)); they meet the tiles by tile key, and the weighted sum is a fold over
the list, so a cell never becomes a row. The shuffle carries one partial pair a region, tile
and time step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import area_weight
from ..sources.grid import GridSpec, with_cell_keys
from .joins import sized_broadcast

ROWS, COLUMNS = 16, 16


def _dense(entries, n: int):
    """The array of n values (NULL where there is none) of (position, value) entries."""
    by = F.map_from_entries(entries)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.try_element_at(by, i))


def tile_facts(facts: DataFrame, grid: GridSpec, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """``time, year, tr, tc, tile`` of a long table ``(time, year, lat, lon, v)``; a cell
    with several values in a time step gets their mean."""
    cells = with_cell_keys(facts, grid).groupBy("time", "year", "ilat", "ilon").agg(F.avg("v").alias("v"))
    place = cells.select("time", "year", F.floor(F.col("ilat") / rows).cast("int").alias("tr"),
                         F.floor(F.col("ilon") / columns).cast("int").alias("tc"), "ilat", "ilon", "v")
    lines = (place.groupBy("time", "year", "tr", "tc", "ilat")
             .agg(F.collect_list(F.struct(F.col("ilon") - F.col("tc") * columns, "v")).alias("e"))
             .select("time", "year", "tr", "tc", (F.col("ilat") - F.col("tr") * rows).alias("r"), _dense(F.col("e"), columns).alias("line")))
    return (lines.groupBy("time", "year", "tr", "tc").agg(F.collect_list(F.struct("r", "line")).alias("e"))
            .select("time", "year", "tr", "tc", _dense(F.col("e"), rows).alias("tile")))


def tile_weights(cover: DataFrame, grid: GridSpec, weighted: bool = True, rows: int = ROWS,
                 columns: int = COLUMNS) -> DataFrame:
    """``region_id, tr, tc, weights`` (row and column in the tile, weight) of a cell cover."""
    w = area_weight(grid.lat_of(F.col("ilat"))) if weighted else F.lit(1.0)
    tr, tc = F.floor(F.col("ilat") / rows).cast("int"), F.floor(F.col("ilon") / columns).cast("int")
    return (cover.select("region_id", tr.alias("tr"), tc.alias("tc"), F.struct(
                (F.col("ilat") - tr * rows).cast("int").alias("r"), (F.col("ilon") - tc * columns).cast("int").alias("c"),
                w.alias("w")).alias("e"))
            .groupBy("region_id", "tr", "tc").agg(F.collect_list("e").alias("weights")))    # rows x columns at most


def monthly_over_tiles(tiles: DataFrame, weights: DataFrame) -> DataFrame:
    """``(region_id, year, time, mt)``: weighted means of the tiles' non-NULL values, for
    the time steps that have one."""
    def value(e):
        return F.get(F.get("tile", e["r"]), e["c"])

    begin = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w"))
    fold = F.aggregate("weights", begin, lambda acc, e: F.when(value(e).isNull(), acc).otherwise(
        F.struct((acc["s"] + e["w"] * value(e)).alias("s"), (acc["w"] + e["w"]).alias("w"))))
    joined = tiles.join(sized_broadcast(weights), ["tr", "tc"]).select("region_id", "year", "time", fold.alias("f"))
    return (joined.groupBy("region_id", "year", "time").agg(F.try_divide(F.sum("f.s"), F.sum("f.w")).alias("mt"))
            .where(F.col("mt").isNotNull()))
