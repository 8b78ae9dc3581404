"""Polygon sources: GeoJSON feature collections -> region rows.

Region rows are ``(region_id INT, name STRING, parts ARRAY<ARRAY<ARRAY<STRUCT<lon, lat>>>>)``
(part -> ring -> vertex, ring 0 of a part is its shell). No geometry library is
needed: GeoJSON coordinates are parsed with ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import resolve_country_column

_FEATURES = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),   # raw JSON text, parsed per type
        ])),
    ]))),
])

_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def _to_points(coords4):
    """array<array<array<array<double>>>> -> part/ring/vertex structs."""
    return F.transform(coords4, lambda part: F.transform(part, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))))


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: ``feature_pos, properties, geom_type, parts`` (parts NULL for
    null/other geometries, empty for empty ones). Features are numbered through all
    files of a folder, in order of the files' paths."""
    raw = (spark.read.schema(_FEATURES).option("multiLine", True).json(path)
           .select("features", F.col("_metadata.file_path").alias("file")))
    # one row per file: where its numbers begin
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    begin = (raw.groupBy("file").agg(F.sum(F.greatest(F.size("features"), F.lit(0))).alias("n"))
             .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")))
    f = (raw.select("file", F.posexplode("features").alias("pos", "f")).join(begin, "file")
         .select((F.col("begin") + F.col("pos")).cast("int").alias("feature_pos"), "f"))
    gtype = F.col("f.geometry.type")
    coords = F.col("f.geometry.coordinates")
    parts4 = (F.when(gtype == "Polygon", F.array(F.from_json(coords, _POLY)))
              .when(gtype == "MultiPolygon", F.from_json(coords, _MULTI)))
    return f.select(
        "feature_pos",
        F.col("f.properties").alias("properties"),
        gtype.alias("geom_type"),
        _to_points(parts4).alias("parts"),
    )


def regions_from_features(features: DataFrame, country_col: str | None = None) -> tuple[DataFrame, str]:
    """Resolve the name property and number regions in source order.

    The property key list is gathered with one small aggregate over the feature
    table (bounded by the number of distinct property names).
    """
    keys = [r["k"] for r in features.select("feature_pos", F.explode(F.map_keys("properties")).alias("k"))
            .groupBy("k").agg(F.min("feature_pos").alias("first"))
            .orderBy("first", "k").collect()]
    col = resolve_country_column(keys, country_col)
    out = features.select(
        F.col("feature_pos").cast("int").alias("region_id"),
        F.col("properties")[col].alias("name"),
        "parts",
    )
    return out, col


def write_region_table(regions: DataFrame, path: str) -> None:
    """Polygon table in Parquet: the regions with the bounds of their outlines, in files of
    neighbouring latitudes, so that a reader of a band opens few files and row groups."""
    points = F.flatten(F.flatten("parts"))
    lats, lons = F.transform(points, lambda p: p["lat"]), F.transform(points, lambda p: p["lon"])
    bounded = regions.withColumns({"lat_min": F.array_min(lats), "lat_max": F.array_max(lats),
                                   "lon_min": F.array_min(lons), "lon_max": F.array_max(lons)})
    (bounded.repartitionByRange("lat_min", "region_id").sortWithinPartitions("lat_min", "region_id")
     .write.mode("overwrite").parquet(path))


def read_region_table(spark: SparkSession, path: str, south: float | None = None, north: float | None = None) -> DataFrame:
    """``region_id, name, parts`` of the regions of a polygon table that reach into the band
    from ``south`` to ``north`` (both ends included; None: open). The bounds are pushed to the
    scan, so outlines elsewhere are not read. Without a band, regions without outlines too."""
    table = spark.read.parquet(path)
    if south is not None:
        table = table.where(F.col("lat_max") >= south)
    if north is not None:
        table = table.where(F.col("lat_min") <= north)
    return table.select("region_id", "name", "parts")
