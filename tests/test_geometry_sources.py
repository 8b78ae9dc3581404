"""GeoJSON regions; the reference's three geometry tests restated on our tables."""

import json

import pytest
from pyspark.sql import functions as F

from gridpanel.functions.columns import resolve_country_column, resolve_time_column, resolve_time_column_in_order
from gridpanel.operators.geometry import clean_regions, is_empty_geometry
from gridpanel.operators.shapes import centroid, representative_point
from gridpanel.session import scratch_path
from gridpanel.sources.polygons import read_geojson_features, regions_from_features


def geojson(spark):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ADMIN": "Squareland", "ISO": "SQL"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]]}},
        {"type": "Feature", "properties": {"ADMIN": "Twoparts"},
         "geometry": {"type": "MultiPolygon", "coordinates": [
             [[[20, 0], [22, 0], [22, 2], [20, 2], [20, 0]]],
             [[[30, 0], [40, 0], [40, 10], [30, 10], [30, 0]], [[32, 2], [38, 2], [38, 8], [32, 8], [32, 2]]]]}},
        {"type": "Feature", "properties": {"ADMIN": "Nowhere"}, "geometry": None},
        {"type": "Feature", "properties": {"ADMIN": "Emptyland"},
         "geometry": {"type": "MultiPolygon", "coordinates": []}},
    ]}
    path = scratch_path(spark, "countries") + ".geojson"
    spark.createDataFrame([(json.dumps(fc),)], "v string").coalesce(1).write.text(path)
    return path


def test_sanitize_and_regions(spark):
    regions, col = regions_from_features(read_geojson_features(spark, geojson(spark)))
    assert col == "ADMIN"
    clean = clean_regions(regions)
    rows = clean.orderBy("region_id").collect()
    assert len(rows) > 0
    assert clean.where(F.col("parts").isNull() | is_empty_geometry(F.col("parts"))).count() == 0
    assert all(r["name"] is not None for r in rows)
    assert [r["name"] for r in rows] == ["Squareland", "Twoparts"]      # region order = row order


def test_explicit_and_detected_country_column():
    assert resolve_country_column(["NAME", "name"]) == "NAME"
    with pytest.raises(ValueError):
        resolve_country_column(["id"])
    with pytest.raises(ValueError):
        resolve_country_column(["ADMIN"], "COUNTRY")


def test_time_column_resolution():
    assert resolve_time_column(["lat", "Valid_Time", "time"]) == "time"
    assert resolve_time_column(["lat", "obs_time_utc"]) == "obs_time_utc"
    assert resolve_time_column(["lat", "lon"]) is None
    assert resolve_time_column_in_order(["date", "time"]) == "date"
    assert resolve_time_column_in_order(["a", "b"]) == "a"


def test_shapes_on_multipolygon_with_hole(spark):
    regions, _ = regions_from_features(read_geojson_features(spark, geojson(spark)))
    clean = clean_regions(regions)
    c = {r["region_id"]: (r["cx"], r["cy"]) for r in centroid(clean).collect()}
    assert c[0] == pytest.approx((5.0, 5.0))
    # area-weighted: small square (area 4, centre 21,1) and a frame (area 64, centre 35,5)
    assert c[1] == pytest.approx(((4 * 21 + 64 * 35) / 68, (4 * 1 + 64 * 5) / 68))
    rp = {r["region_id"]: (r["rx"], r["ry"]) for r in representative_point(clean).collect()}
    assert rp[0] == pytest.approx((5.0, 5.0))
    # the frame's scan line (y=5) gives intervals [30,32] and [38,40]; the square's
    # gives [20,22]: all width 2, so the first part wins the tie
    assert rp[1] == pytest.approx((21.0, 1.0))
