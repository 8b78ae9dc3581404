"""Region -> grid-cell cover: which cell centres count for which region.

``scanline_cover`` is the containment join (cells whose centre lies inside a
polygon, even-odd rule per part, union over parts, overlaps between regions kept).
``buffered_cover`` adds cells whose centre is within ``buffer_m`` metres of the
polygon in the EPSG:6933 plane.

Both are expressed as edge explosions plus one window and one distinct: cost is
proportional to boundary length x rows crossed plus covered cells, never to
regions x cells, and a single huge region is spread over many tasks because the
work is keyed by (region, part, row), not by region.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geodesy import (K0, WGS84_A, ease_lat_of_y, ease_x, ease_xy_py, ease_y,
                                 point_segment_distance2)
from ..sources.grid import GridSpec


def _clip(c, lo, hi):
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def scanline_crossings(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Crossings of polygon edges with grid rows: ``region_id, part_id, ilat, x``.

    Half-open rule: an edge crosses row latitude L iff min(y0, y1) <= L < max(y0, y1),
    so vertices on a row and horizontal edges are counted consistently.
    """
    y0, y1, x0, x1 = (F.col(c) for c in ("y0", "y1", "x0", "x1"))
    ymin, ymax = F.least(y0, y1), F.greatest(y0, y1)
    # candidate rows, widened by one on each side and then tested exactly
    lo = _clip(F.ceil((ymin - F.lit(grid.lat0)) / F.lit(grid.dlat)).cast("int") - 1, 0, grid.nlat - 1)
    hi = _clip(F.ceil((ymax - F.lit(grid.lat0)) / F.lit(grid.dlat)).cast("int"), 0, grid.nlat - 1)
    e = edges.where((y0 != y1) & (lo <= hi))
    rows = e.select("region_id", "part_id", "x0", "y0", "x1", "y1",
                    F.explode(F.sequence(lo, hi)).alias("ilat"))
    L = grid.lat_of(F.col("ilat"))
    rows = rows.where((F.least("y0", "y1") <= L) & (L < F.greatest("y0", "y1")))
    x = F.col("x0") + (L - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    return rows.select("region_id", "part_id", "ilat", x.alias("x"))


def scanline_cover(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Cells whose centre is inside a region: ``region_id, ilat, ilon`` (distinct).

    Per (region, part, row) the sorted crossings pair up into interior intervals
    [xa, xb); a cell counts when xa <= lon < xb. Parity is per part, then parts
    are unioned with ``distinct`` so overlapping parts do not cancel.
    """
    # one shuffle on (region, row): it satisfies both the per-part window below and
    # the final distinct on (region, row, column), and spreads a large region by row
    cr = scanline_crossings(edges, grid).repartition("region_id", "ilat")
    w = Window.partitionBy("region_id", "part_id", "ilat").orderBy("x")
    pairs = (cr.withColumn("k", F.row_number().over(w))
             .withColumn("xb", F.lead("x").over(w))
             .where((F.col("k") % 2 == 1) & F.col("xb").isNotNull())
             .select("region_id", "ilat", F.col("x").alias("xa"), "xb"))
    clo = _clip(F.ceil((F.col("xa") - F.lit(grid.lon0)) / F.lit(grid.dlon)).cast("int") - 1, 0, grid.nlon - 1)
    chi = _clip(F.ceil((F.col("xb") - F.lit(grid.lon0)) / F.lit(grid.dlon)).cast("int"), 0, grid.nlon - 1)
    cells = (pairs.where(clo <= chi)
             .select("region_id", "ilat", "xa", "xb", F.explode(F.sequence(clo, chi)).alias("ilon")))
    lon = grid.lon_of(F.col("ilon"))
    return (cells.where((lon >= F.col("xa")) & (lon < F.col("xb")))
            .select("region_id", "ilat", "ilon").distinct())


def boundary_cells(edges: DataFrame, grid: GridSpec, buffer_m: float) -> DataFrame:
    """Cells within ``buffer_m`` metres (EPSG:6933 plane) of any region edge.

    Each projected edge is cut into pieces no longer than ``max(2*buffer, cell width)``;
    each piece's bounding box grown by the buffer is turned into a row/column range
    (x is linear in longitude; y is inverted to latitude in closed form and the
    range is widened by one row), the candidates are exploded and the exact
    point-to-segment distance decides. Candidates per piece are bounded by the
    piece size, so the explosion is linear in boundary length.
    """
    b = float(buffer_m)
    cell_m = WGS84_A * K0 * math.radians(grid.dlon)
    piece = max(2.0 * b, cell_m)
    px0, py0 = ease_x(F.col("x0")), ease_y(F.col("y0"))
    px1, py1 = ease_x(F.col("x1")), ease_y(F.col("y1"))
    proj = edges.select("region_id", px0.alias("ax"), py0.alias("ay"), px1.alias("bx"), py1.alias("by"))
    seg_len = F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2))
    k = F.greatest(F.lit(1), F.ceil(seg_len / F.lit(piece)).cast("int"))
    pieces = proj.select("*", k.alias("k")).select(
        "region_id", "ax", "ay", "bx", "by", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("j"))
    t0, t1 = F.col("j") / F.col("k"), (F.col("j") + 1) / F.col("k")
    sx0 = F.col("ax") + (F.col("bx") - F.col("ax")) * t0
    sy0 = F.col("ay") + (F.col("by") - F.col("ay")) * t0
    sx1 = F.col("ax") + (F.col("bx") - F.col("ax")) * t1
    sy1 = F.col("ay") + (F.col("by") - F.col("ay")) * t1
    pieces = pieces.select("region_id", sx0.alias("sx0"), sy0.alias("sy0"), sx1.alias("sx1"), sy1.alias("sy1"))
    # pieces are a few bytes each but fan out into many candidate cells: hash them
    # over every core before the fan-out, so that a long outline is not tested in
    # the one task that read its region row. An explicit count, because AQE would
    # coalesce such a small shuffle (by bytes) back into one partition.
    session = pieces.sparkSession
    n = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    pieces = pieces.repartition(n, "region_id", "sx0", "sy0")

    to_lon = F.lit(180.0 / (math.pi * WGS84_A * K0))
    lon_lo = (F.least("sx0", "sx1") - F.lit(b)) * to_lon
    lon_hi = (F.greatest("sx0", "sx1") + F.lit(b)) * to_lon
    lat_lo = ease_lat_of_y(F.least("sy0", "sy1") - F.lit(b))
    lat_hi = ease_lat_of_y(F.greatest("sy0", "sy1") + F.lit(b))
    c_lo = _clip(F.floor((lon_lo - F.lit(grid.lon0)) / F.lit(grid.dlon)).cast("int"), 0, grid.nlon - 1)
    c_hi = _clip(F.ceil((lon_hi - F.lit(grid.lon0)) / F.lit(grid.dlon)).cast("int"), 0, grid.nlon - 1)
    r_lo = _clip(F.floor((lat_lo - F.lit(grid.lat0)) / F.lit(grid.dlat)).cast("int") - 1, 0, grid.nlat - 1)
    r_hi = _clip(F.ceil((lat_hi - F.lit(grid.lat0)) / F.lit(grid.dlat)).cast("int") + 1, 0, grid.nlat - 1)
    cand = (pieces.select("*", r_lo.alias("r_lo"), r_hi.alias("r_hi"), c_lo.alias("c_lo"), c_hi.alias("c_hi"))
            .where((F.col("r_lo") <= F.col("r_hi")) & (F.col("c_lo") <= F.col("c_hi")))
            .select("region_id", "sx0", "sy0", "sx1", "sy1", "c_lo", "c_hi",
                    F.explode(F.sequence("r_lo", "r_hi")).alias("ilat"))
            .select("region_id", "sx0", "sy0", "sx1", "sy1", "ilat",
                    F.explode(F.sequence("c_lo", "c_hi")).alias("ilon")))
    # projected cell centres depend on the row or the column only: look them up in
    # per-axis constant arrays (nlat + nlon values) instead of re-projecting each candidate
    xs = F.array(*[F.lit(ease_xy_py(grid.lon0 + grid.dlon * c, 0.0)[0]) for c in range(grid.nlon)])
    ys = F.array(*[F.lit(ease_xy_py(0.0, grid.lat0 + grid.dlat * r)[1]) for r in range(grid.nlat)])
    cx, cy = F.element_at(xs, F.col("ilon") + 1), F.element_at(ys, F.col("ilat") + 1)
    d2 = point_segment_distance2(cx, cy, F.col("sx0"), F.col("sy0"), F.col("sx1"), F.col("sy1"))
    return cand.where(d2 <= F.lit(b * b)).select("region_id", "ilat", "ilon")


def buffered_cover(edges: DataFrame, grid: GridSpec, buffer_m: float) -> DataFrame:
    """Containment cover united with the cells within ``buffer_m`` of the outline.

    ``buffer_m <= 0`` disables the buffer (plain containment)."""
    inside = scanline_cover(edges, grid)
    if buffer_m is None or buffer_m <= 0:
        return inside
    return inside.unionByName(boundary_cells(edges, grid, buffer_m)).distinct()
