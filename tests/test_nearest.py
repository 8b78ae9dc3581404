"""Nearest node against brute force over every node, on odd points and grids."""

import math
import random

import pytest

from gridpanel.functions.geodesy import haversine_py
from gridpanel.operators.nearest import nearest_node
from gridpanel.sources.grid import GridSpec

GLOBE = GridSpec(lat0=-90.0, dlat=5.0, nlat=37, lon0=-180.0, dlon=5.0, nlon=72, src_lon0=0.0)
PART = GridSpec(lat0=30.0, dlat=2.5, nlat=13, lon0=-10.0, dlon=2.5, nlon=17)
SOUTH = GridSpec(lat0=-90.0, dlat=1.0, nlat=3, lon0=0.0, dlon=1.0, nlon=2)


def points_of(spark, rows):
    return spark.createDataFrame(rows, "region_id long, plat double, plon double")


@pytest.mark.parametrize("grid", [GLOBE, PART, SOUTH], ids=["globe", "part", "south"])
def test_nearest_node_is_the_nearest_of_all(spark, grid):
    rnd = random.Random(5)
    at = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(150)]
    at += [(90.0, 0.0), (-90.0, 17.0), (89.9, 179.9), (0.0, 80.0), (0.0, 99.9), (-45.0, 190.0), (62.4, 181.0), (0.0, -100.0)]
    got = {r.region_id: r for r in nearest_node(points_of(spark, [(i, *p) for i, p in enumerate(at)]), grid).collect()}
    assert len(got) == len(at)
    for i, (lat, lon) in enumerate(at):
        least = min(haversine_py(lat, lon, grid.lat0 + grid.dlat * r, grid.lon0 + grid.dlon * c)
                    for r in range(grid.nlat) for c in range(grid.nlon))
        g = got[i]
        assert math.isclose(g.min_km, least, rel_tol=1e-9, abs_tol=1e-6)
        assert (g.near_lat, g.near_lon) == (grid.lat0 + grid.dlat * g.ilat, grid.lon0 + grid.dlon * g.ilon)
        assert math.isclose(haversine_py(lat, lon, g.near_lat, g.near_lon), least, rel_tol=1e-9, abs_tol=1e-6)


def test_repeated_keys_and_points_without_coordinates(spark):
    rows = [(1, 1.0, 1.0), (1, 4.9, 4.9), (2, None, None), (None, 10.2, 0.0), (3, 2.5, 0.0)]
    got = {r.region_id: (r.ilat, r.near_lat, r.near_lon, r.min_km) for r in nearest_node(points_of(spark, rows), GLOBE).collect()}
    assert got[1][1:3] == (5.0, 5.0)
    assert got[2] == (0, -90.0, None, None)
    assert got[None][1:3] == (10.0, 0.0)
    assert got[3][1:3] == (5.0, 0.0)        # as near as (0, 0): the first from the north


def test_candidates_of_a_point_are_not_rows(spark):
    """The sort before the aggregate held every candidate of every point."""
    plan = nearest_node(points_of(spark, [(1, 1.0, 1.0)]), GLOBE)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
