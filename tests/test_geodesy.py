import math

import pytest

from gridpanel.functions.geodesy import ease_xy_py, haversine_py


def test_ease_extents():
    x, y = ease_xy_py(180.0, 90.0)
    assert x == pytest.approx(17367530.445, abs=1e-3)
    assert y == pytest.approx(7342230.136, abs=1e-3)


def test_haversine_degree():
    assert haversine_py(0, 0, 1, 0) == pytest.approx(111.19508, abs=1e-4)


def test_spark_matches_python(spark):
    from pyspark.sql import functions as F

    from gridpanel.functions.geodesy import ease_lat_of_y, ease_x, ease_y, haversine_km

    pts = [(12.5, 41.9), (-73.9, 40.7), (151.2, -33.9), (0.0, 0.0), (179.9, 89.0)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    rows = df.select(ease_x("lon").alias("x"), ease_y("lat").alias("y"),
                     ease_lat_of_y(ease_y("lat")).alias("back"),
                     haversine_km(F.lit(0.0), F.lit(0.0), F.col("lat"), F.col("lon")).alias("d")).collect()
    for (lon, lat), r in zip(pts, rows):
        x, y = ease_xy_py(lon, lat)
        assert r["x"] == pytest.approx(x) and r["y"] == pytest.approx(y)
        assert r["back"] == pytest.approx(lat, abs=1e-7)
        assert r["d"] == pytest.approx(haversine_py(0, 0, lat, lon))
