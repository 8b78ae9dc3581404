"""Nearest grid node to a point, and the fallback series built from it.

Exact arg-min without a regions x cells cross product: on a lat/lon grid every
row has the same longitudes, and for a fixed row the haversine distance grows
with |dlon| (hav(d) = hav(dlat) + cos(lat1) cos(lat2) hav(dlon), cosines >= 0).
So the nearest node of each row lies in the column(s) nearest in longitude,
the same for all rows: at most four (the two neighbours of the point's longitude,
plus the two axis ends for grids that do not span the full circle).

Along a column cos(d) = A cos(lat - top) with top = atan2(sin(lat1), cos(lat1)
cos(dlon)), so the nearest row is one of the two beside ``top``, or the axis end
towards it. Candidates are these and one more on either side: the others are
farther by far more than rounding. Where that is not sure (the column a quarter
of the circle away, so that A may vanish; rows near the antipode; a point without
coordinates) every row is a candidate. Exact, O(1) per point otherwise; ties
resolve to the first node in the source's row-major order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import haversine_km, wrap_lon
from ..sources.grid import GridSpec


def nearest_node(points: DataFrame, grid: GridSpec, key: str = "region_id",
                 lat: str = "plat", lon: str = "plon") -> DataFrame:
    """``(key, ilat, ilon, near_lat, near_lon, min_km)`` for each point."""
    pos = (wrap_lon(F.col(lon)) - F.lit(grid.lon0)) / F.lit(grid.dlon)
    c0 = F.floor(pos).cast("int")
    if grid.full_circle():
        cands = F.array(F.pmod(c0, F.lit(grid.nlon)), F.pmod(c0 + 1, F.lit(grid.nlon)))
    else:
        clip = lambda c: F.greatest(F.lit(0), F.least(F.lit(grid.nlon - 1), c))
        cands = F.array(clip(c0), clip(c0 + 1), F.lit(0), F.lit(grid.nlon - 1))
    p = points.select(F.col(key).alias(key), F.col(lat).alias("_plat"), F.col(lon).alias("_plon"),
                      F.array_distinct(cands).alias("_cols"))

    last = grid.nlat - 1

    def nearest_row(c):
        # along a column cos(d) = A cos(lat - top), A > 0
        cosd = F.cos(F.radians(grid.lon_of(c)) - F.radians(F.col("_plon")))
        top = F.degrees(F.atan2(F.sin(F.radians(F.col("_plat"))), F.cos(F.radians(F.col("_plat"))) * cosd))
        return F.struct(c.alias("c"), cosd.alias("cosd"), top.alias("top"))

    def below(s):
        r = F.floor((s["top"] - F.lit(grid.lat0)) / F.lit(grid.dlat))
        r = F.greatest(F.lit(0), F.least(F.lit(last), r)).cast("int")
        return F.struct(s["c"].alias("c"), s["cosd"].alias("cosd"), s["top"].alias("top"), r.alias("r"))

    def node(ilat, ilon):
        nlat_, nlon_ = grid.lat_of(ilat), grid.lon_of(ilon)
        return F.struct(haversine_km(F.col("_plat"), F.col("_plon"), nlat_, nlon_).alias("d"),
                        grid.cell_order(ilat, ilon).alias("order"), ilat.alias("ilat"), ilon.alias("ilon"),
                        nlat_.alias("near_lat"), nlon_.alias("near_lon"))

    def least(s):
        sure = (s["cosd"] > 0.1) & (F.abs(s["top"] - grid.lat_of(s["r"])) < 89.0)
        near = F.sequence(F.greatest(F.lit(0), s["r"] - 1), F.least(F.lit(last), s["r"] + 2))
        rows = F.when(sure, near).otherwise(F.sequence(F.lit(0), F.lit(last)))
        return F.array_min(F.transform(rows, lambda i: node(i, s["c"])))

    # candidates meet inside the point's row: one row a point is shuffled and sorted
    cols = F.transform(F.transform(F.col("_cols"), nearest_row), below)
    best = p.select(key, F.array_min(F.transform(cols, least)).alias("b")).groupBy(key).agg(F.min("b").alias("b"))
    return best.select(key, "b.ilat", "b.ilon", "b.near_lat", "b.near_lon", F.col("b.d").alias("min_km"))


def status_text(cap_km: float) -> str:
    """``no_cell_within_{cap}km`` with Python's float rendering (25.0 -> '25.0')."""
    return f"no_cell_within_{float(cap_km)!r}km"


def fallback_plan(missing: DataFrame, points: DataFrame, grid: GridSpec, cap_km: float,
                  key: str = "region_id") -> tuple[DataFrame, DataFrame]:
    """For regions in ``missing`` (``key, name``): the accepted fallback cells
    ``(key, ilat, ilon)`` and the audit ``(key, country, status, min_km, near_lat, near_lon)``.

    A distance equal to the cap is accepted; beyond it the region is audited with
    its true minimum distance."""
    near = nearest_node(missing.join(points, key), grid, key)
    m = missing.join(near, key, "left")
    ok = F.col("min_km") <= F.lit(float(cap_km))
    audit = m.select(
        key, F.col("name").alias("country"),
        F.when(F.col("min_km").isNull(), F.lit("no_geometry"))
         .when(ok, F.lit("fallback_used")).otherwise(F.lit(status_text(cap_km))).alias("status"),
        "min_km",
        F.when(ok, F.col("near_lat")).alias("near_lat"),
        F.when(ok, F.col("near_lon")).alias("near_lon"),
    )
    cells = m.where(ok).select(key, "ilat", "ilon")
    return cells, audit
