"""Polygon tables as DataFrames: cleaning, dissolving by name, edge explosion.

Polygons stay plain nested arrays; every operation is a Spark expression, so the
work is split by region and by edge across the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SALTS = 16      # parts that the rows of one name are dealt into


def one_region_per_name(regions: DataFrame) -> DataFrame:
    """Dissolved regions as they are, others dissolved: same-named rows are one region."""
    return regions if "src_id" in regions.columns else dissolve_by_name(regions)


def _closed(ring: Column) -> Column:
    """Ring with its closing vertex (GeoJSON rings are closed; be lenient)."""
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    return F.when((first.lon == last.lon) & (first.lat == last.lat), ring).otherwise(
        F.concat(ring, F.array(first)))


def is_empty_geometry(parts: Column) -> Column:
    """True when a geometry has no usable ring (fewer than 4 points once closed)."""
    usable = F.filter(parts, lambda p: F.size(F.filter(p, lambda r: F.size(_closed(r)) >= 4)) > 0)
    return F.size(usable) == 0


def clean_regions(regions: DataFrame) -> DataFrame:
    """Drop null and empty geometries; drop degenerate rings and parts.

    Raises when nothing is left is the caller's business (``quality.require_rows``).
    """
    def keep_ring(r):
        return F.size(_closed(r)) >= 4

    parts = F.filter(
        F.transform(F.col("parts"), lambda p: F.filter(p, keep_ring)),
        lambda p: F.size(p) > 0,
    )
    return (regions.where(F.col("parts").isNotNull())
            .withColumn("parts", parts)
            .where(F.size("parts") > 0))


def dissolve_by_name(regions: DataFrame) -> DataFrame:
    """One region per name: every polygon row of a name is relabelled with the
    name's smallest ``region_id`` and keeps its own id as ``src_id``.

    The polygons are not gathered into one row: a region may span several rows,
    and the operators combine them (the cover is the union of the rows' cells,
    keyed per source polygon part; centroid and representative point aggregate
    over the rows). So a name holding a large share of the polygon table costs a
    partially aggregated ``min`` and a join, never one oversized row or task.
    """
    # a join with an aggregate cannot be split at run time: deal each name over SALTS tasks
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    first = regions.groupBy("name").agg(F.min("region_id").alias("_rid")).withColumn("_salt", salts)
    salted = regions.withColumn("_salt", F.pmod(F.xxhash64("region_id"), F.lit(SALTS)).cast("int"))
    return (salted.join(first, ["name", "_salt"])
            .select(F.col("_rid").alias("region_id"), "name", "parts",
                    F.col("region_id").alias("src_id")))


def region_names(regions: DataFrame) -> DataFrame:
    """The region dimension ``(region_id, name)``: one row per region, also when a
    (dissolved) region spans several polygon rows."""
    names = regions.select("region_id", "name")
    return names.distinct() if "src_id" in regions.columns else names


def region_edges(regions: DataFrame) -> DataFrame:
    """One row per ring segment: ``region_id, part_id, ring_id, seg_id, x0, y0, x1, y1``
    (x = lon, y = lat, degrees). For dissolved regions ``part_id`` is
    ``(src_id, part)``, so that parts of different source rows never mix."""
    p = regions.select("region_id", F.posexplode("parts").alias("part_id", "part"),
                       *(["src_id"] if "src_id" in regions.columns else []))
    if "src_id" in regions.columns:
        # rows of a dissolved region: parity is decided per source polygon part
        p = p.withColumn("part_id", F.struct("src_id", "part_id")).drop("src_id")
    r = (p.select("region_id", "part_id", F.posexplode("part").alias("ring_id", "ring"))
         .select("region_id", "part_id", "ring_id", _closed(F.col("ring")).alias("ring")))
    ring = F.col("ring")   # closed once in its own projection, then indexed
    segs = F.transform(F.sequence(F.lit(1), F.size(ring) - 1),
                       lambda i: F.struct(i.alias("i"), F.element_at(ring, i).alias("a"),
                                          F.element_at(ring, i + 1).alias("b")))
    e = r.where(F.size("ring") >= 2).select("region_id", "part_id", "ring_id", F.explode(segs).alias("s"))
    return e.select(
        "region_id", "part_id", "ring_id",
        (F.col("s.i") - 1).alias("seg_id"),
        F.col("s.a.lon").alias("x0"), F.col("s.a.lat").alias("y0"),
        F.col("s.b.lon").alias("x1"), F.col("s.b.lat").alias("y1"),
    )
