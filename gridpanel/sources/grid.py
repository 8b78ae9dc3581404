"""Gridded fact sources: long (time, lat, lon, value) tables and their grid axes.

A grid is the product of a latitude axis and a longitude axis. Cells are keyed by
integer positions ``ilat``/``ilon`` on the *ascending, wrapped* axes (longitude
mapped to -180..180). The source's own axis order (latitude usually runs north
to south) is kept in the spec so that "first in row-major order" tie-breaks can
be reproduced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import resolve_time_column
from ..functions.geodesy import kelvin_to_celsius, wrap_lon


@dataclass(frozen=True)
class GridSpec:
    """Regular lat/lon axes in ascending wrapped coordinates."""

    lat0: float
    dlat: float
    nlat: int
    lon0: float
    dlon: float
    nlon: int
    lat_descending: bool = True   # source stores latitude north -> south
    src_lon0: float | None = None  # first longitude in source order (before wrap)

    # -- axis arithmetic as column expressions ---------------------------------
    def lat_of(self, ilat) -> Column:
        return F.lit(self.lat0) + F.lit(self.dlat) * ilat

    def lon_of(self, ilon) -> Column:
        return F.lit(self.lon0) + F.lit(self.dlon) * ilon

    def ilat_of(self, lat) -> Column:
        return F.round((lat - F.lit(self.lat0)) / F.lit(self.dlat)).cast("int")

    def ilon_of(self, wrapped_lon) -> Column:
        return F.round((wrapped_lon - F.lit(self.lon0)) / F.lit(self.dlon)).cast("int")

    def full_circle(self) -> bool:
        return abs(self.nlon * self.dlon - 360.0) < 1e-9

    def src_lat_pos(self, ilat) -> Column:
        return (F.lit(self.nlat - 1) - ilat) if self.lat_descending else ilat

    def src_lon_pos(self, ilon) -> Column:
        """Position of a wrapped column in the source's longitude order."""
        if self.src_lon0 is None:
            return ilon
        raw = self.lon_of(ilon)
        # source longitudes run from src_lon0 upward, possibly past 180
        src = F.when(raw < F.lit(self.src_lon0) - F.lit(1e-9), raw + F.lit(360.0)).otherwise(raw)
        return F.round((src - F.lit(self.src_lon0)) / F.lit(self.dlon)).cast("int")

    def cell_order(self, ilat, ilon) -> Column:
        """Row-major order of a cell in the source layout (for arg-min ties)."""
        return self.src_lat_pos(ilat).cast("long") * F.lit(self.nlon) + self.src_lon_pos(ilon)

    @staticmethod
    def from_facts(facts: DataFrame, lat: str = "lat", lon: str = "lon",
                   lat_descending: bool = True) -> "GridSpec":
        """Derive the axes from a long fact table: the distinct latitudes and longitudes
        (bounded by the grid, not by the rows), which must be evenly spaced."""
        def axis(c: Column) -> list[float]:
            return [r.x for r in facts.select(c.cast("double").alias("x")).distinct().collect() if r.x is not None]

        source = facts.agg(F.min(lon).alias("s0")).first()["s0"]
        return GridSpec.from_axes(axis(F.col(lat)), axis(wrap_lon(F.col(lon))), source, lat_descending)

    @staticmethod
    def from_axes(lats: list[float], lons: list[float], src_lon0: float | None,
                  lat_descending: bool = True) -> "GridSpec":
        """From the values of both axes (longitudes wrapped), which must be evenly spaced."""
        def regular(found: list[float], what: str) -> tuple[float, float, int]:
            found = sorted(found)
            if not found:
                raise ValueError("cannot derive a grid from an empty fact table")
            steps = [b - a for a, b in zip(found, found[1:], strict=False)]
            step = min(steps, default=1.0)
            for a, d in zip(found, steps, strict=False):
                if abs(d - step) > 1e-6 * max(1.0, abs(step)):
                    raise ValueError(f"{what} axis is not even: step {step:g}, but {a:g} is followed by {a + d:g}")
            return found[0], (found[-1] - found[0]) / len(steps) if steps else 1.0, len(found)

        return GridSpec(*regular(lats, "latitude"), *regular(lons, "longitude"), lat_descending,
                        None if src_lon0 is None else float(src_lon0))


def grids_by_year(facts: DataFrame) -> list[tuple[GridSpec, list[int]]]:
    """The grids that the years are on, each with its years: usually one for all. A year's
    file may have another extent; its axes are those of all its time steps, of which one may
    hold less than another. The driver sees one pair of axes for each year."""
    rows = facts.groupBy("year").agg(F.collect_set("lat").alias("lats"), F.collect_set(wrap_lon(F.col("lon"))).alias("lons"),
                                     F.min("lon").alias("s0")).collect()
    by: dict[GridSpec, list[int]] = {}
    for r in sorted(rows, key=lambda r: r.year):
        by.setdefault(GridSpec.from_axes(r.lats, r.lons, r.s0), []).append(r.year)
    return list(by.items())


def with_cell_keys(facts: DataFrame, grid: GridSpec, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add ``ilat``/``ilon`` integer cell keys (pure projection, no shuffle)."""
    return facts.withColumn("ilat", grid.ilat_of(F.col(lat))).withColumn(
        "ilon", grid.ilon_of(wrap_lon(F.col(lon))))


def normalize_facts(df: DataFrame, value: str = "t2m", lat: str = "latitude", lon: str = "longitude",
                    time: str | None = None, kelvin: bool = True) -> DataFrame:
    """Source rows -> ``(time, year, lat, lon, v)`` in degC with NaN as NULL.

    * resolves the time column by name (``resolve_time_column``),
    * converts Kelvin to Celsius once at the source,
    * maps NaN to NULL (Spark keeps NaN distinct from NULL; the reference does not).
    """
    tcol = time or resolve_time_column(df.columns) or "valid_time"
    v = F.col(value).cast("double")
    v = F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
    if kelvin:
        v = kelvin_to_celsius(v)
    t = F.col(tcol)
    return df.select(
        t.alias("time"),
        F.year(t).alias("year"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
        v.alias("v"),
    )


def year_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """``{year: folder}`` of a table partitioned by year that hold a data file."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    found = {}
    for s in fs.listStatus(p):
        m = re.fullmatch(r"year=(\d+)", s.getPath().getName())
        if m and s.isDirectory() and any(not f.getPath().getName().startswith(("_", "."))
                                         for f in fs.listStatus(s.getPath())):
            found[int(m[1])] = s.getPath().toString()
    return found


def read_grid_years(spark: SparkSession, path: str, years: list[int], on_missing: str = "error",
                    **normalize_kw) -> tuple[DataFrame, list[int]]:
    """Year-partitioned grid scan (``path/year=YYYY/...``) restricted to ``years``.

    Partition pruning keeps the scan to the requested years. Missing years are
    found by listing the ``year=YYYY`` folders (no data is read for it):
    ``on_missing="error"`` raises listing all of them, ``"warn"`` returns them and
    fails only when no year is present.
    """
    have = sorted(set(years) & set(year_folders(spark, path)))
    missing = sorted(set(years) - set(have))
    if missing and (on_missing == "error" or not have):
        raise FileNotFoundError(f"missing grid years: {missing}")
    raw = spark.read.parquet(path)
    facts = normalize_facts(raw.where(F.col("year").isin(years)), **normalize_kw)
    return facts, missing


def array_grid_to_long(df: DataFrame, lats: list[float] | None = None, lons: list[float] | None = None,
                       values: str = "values", time: str = "time") -> DataFrame:
    """Flatten ``ARRAY<ARRAY<DOUBLE>>`` per time step into long ``(time, lat_pos, lon_pos, v)``.

    Two ``posexplode`` calls; coordinates come from the axis arrays when given.
    """
    out = (df.select(F.col(time).alias("time"), F.posexplode(values).alias("lat_pos", "row"))
           .select("time", "lat_pos", F.posexplode("row").alias("lon_pos", "v")))
    if lats is not None:
        out = out.withColumn("lat", F.element_at(F.array(*[F.lit(float(x)) for x in lats]),
                                                 F.col("lat_pos") + 1))
    if lons is not None:
        out = out.withColumn("lon", F.element_at(F.array(*[F.lit(float(x)) for x in lons]),
                                                 F.col("lon_pos") + 1))
    return out


def as_rows(values: Column, width: int) -> Column:
    """A flat array as an array of rows of ``width`` values; the last may be shorter."""
    n = F.ceil(F.size(values) / F.lit(width)).cast("int")
    rows = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.slice(values, i * width + 1, width))
    return F.when(F.size(values) > 0, rows)
