"""Cover (containment + buffer) on hand-made polygons against brute force."""

from pyspark.sql import functions as F

from conftest import poly, regions_df
from gridpanel.operators.cover import buffered_cover, scanline_cover
from gridpanel.operators.geometry import clean_regions, dissolve_by_name, region_edges
from gridpanel.sources.grid import GridSpec

G = GridSpec(lat0=-90.0, dlat=5.0, nlat=37, lon0=-180.0, dlon=5.0, nlon=72)


def cells(df):
    return sorted((r["region_id"], G.lat0 + G.dlat * r["ilat"], G.lon0 + G.dlon * r["ilon"])
                  for r in df.collect())


def brute_inside(rings, lat, lon):
    """Even-odd crossing count with the half-open rule (x <= lon counts)."""
    n = 0
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
            if y0 != y1 and min(y0, y1) <= lat < max(y0, y1):
                if x0 + (lat - y0) * (x1 - x0) / (y1 - y0) <= lon:
                    n += 1
    return n % 2 == 1


def test_box_cover_is_half_open(spark):
    box = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    df = regions_df(spark, [(1, "a", [poly(box)])])
    got = cells(scanline_cover(region_edges(df), G))
    assert got == [(1, lat, lon) for lat in (0.0, 5.0) for lon in (0.0, 5.0)]


def test_overlap_counts_for_both_regions(spark):
    a = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    b = [(5, 5), (15, 5), (15, 15), (5, 15), (5, 5)]
    df = regions_df(spark, [(1, "a", [poly(a)]), (2, "b", [poly(b)])])
    got = cells(scanline_cover(region_edges(df), G))
    assert (1, 5.0, 5.0) in got and (2, 5.0, 5.0) in got


def test_hole_and_multipart(spark):
    shell = [(-20, -20), (20, -20), (20, 20), (-20, 20), (-20, -20)]
    hole = [(-6, -6), (6, -6), (6, 6), (-6, 6), (-6, -6)]
    extra = [(0, 0), (30, 0), (30, 3), (0, 3), (0, 0)]     # overlaps the hole; must not cancel
    df = regions_df(spark, [(7, "h", [poly(shell, hole), poly(extra)])])
    got = set(cells(scanline_cover(region_edges(df), G)))
    expect = set()
    for lat in [G.lat0 + G.dlat * r for r in range(G.nlat)]:
        for lon in [G.lon0 + G.dlon * c for c in range(G.nlon)]:
            if brute_inside([shell, hole], lat, lon) or brute_inside([extra], lat, lon):
                expect.add((7, lat, lon))
    assert got == expect
    assert (7, 0.0, 0.0) in got          # inside the hole, but covered by the second part
    assert (7, 5.0, 0.0) not in got      # inside the hole only


def test_bowtie_even_odd(spark):
    ring = [(0, 0), (20, 20), (20, 0), (0, 20), (0, 0)]
    df = regions_df(spark, [(3, "bow", [poly(ring)])])
    got = set(cells(scanline_cover(region_edges(df), G)))
    expect = {(3, lat, lon) for lat in range(0, 25, 5) for lon in range(0, 25, 5)
              if brute_inside([ring], lat, lon)}
    assert got == {(a, float(b), float(c)) for a, b, c in expect}


def test_thin_island_only_reached_by_buffer(spark):
    isl = [(1, 1), (1.2, 1), (1.2, 1.2), (1, 1.2), (1, 1)]    # ~22 km square, no node inside
    df = regions_df(spark, [(9, "isl", [poly(isl)])])
    e = region_edges(df)
    assert scanline_cover(e, G).count() == 0
    assert buffered_cover(e, G, 15000.0).count() == 0           # nearest node ~123 km away
    got = cells(buffered_cover(e, G, 200000.0))
    assert (9, 0.0, 0.0) in got
    assert got == brute_buffer(9, [isl], 200000.0)


def brute_buffer(rid, rings, b):
    from gridpanel.functions.geodesy import ease_xy_py

    out = []
    for r in range(G.nlat):
        for c in range(G.nlon):
            lat, lon = G.lat0 + G.dlat * r, G.lon0 + G.dlon * c
            px, py = ease_xy_py(lon, lat)
            best = float("inf")
            for ring in rings:
                for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
                    ax, ay = ease_xy_py(x0, y0)
                    bx, by = ease_xy_py(x1, y1)
                    dx, dy = bx - ax, by - ay
                    t = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
                    best = min(best, ((px - ax - t * dx) ** 2 + (py - ay - t * dy) ** 2) ** 0.5)
            if best <= b or brute_inside(rings, lat, lon):
                out.append((rid, lat, lon))
    return sorted(out)


def test_buffer_monotone_and_union(spark):
    a = [(-30, -10), (10, -25), (25, 30), (-30, -10)]
    b = [(40, 40), (60, 40), (50, 55), (40, 40)]
    both = regions_df(spark, [(1, "a", [poly(a), poly(b)])])
    only_a = regions_df(spark, [(1, "a", [poly(a)])])
    only_b = regions_df(spark, [(1, "a", [poly(b)])])
    c0 = set(cells(buffered_cover(region_edges(both), G, 0.0)))
    c1 = set(cells(buffered_cover(region_edges(both), G, 300000.0)))
    assert c0 <= c1 and len(c1) > len(c0)
    # cover of a union = union of covers
    ua = set(cells(scanline_cover(region_edges(only_a), G)))
    ub = set(cells(scanline_cover(region_edges(only_b), G)))
    assert c0 == ua | ub


def test_clean_and_dissolve(spark):
    ok = poly([(0, 0), (10, 0), (10, 10), (0, 0)])
    bad_ring = poly([(0, 0), (1, 1)])
    df = spark.createDataFrame(
        [(1, "x", [ok]), (2, "y", None), (3, "z", []), (4, "x", [bad_ring]), (5, "x", [ok])],
        "region_id int, name string, parts array<array<array<struct<lon:double,lat:double>>>>")
    c = clean_regions(df)
    assert sorted(r["region_id"] for r in c.collect()) == [1, 5]
    d = dissolve_by_name(c).collect()
    # relabelled, not gathered: both rows of "x" now belong to region 1
    assert sorted((r["region_id"], r["src_id"], r["name"]) for r in d) == [(1, 1, "x"), (1, 5, "x")]


def test_dissolved_rows_equal_one_multipolygon(spark):
    """A region spread over several rows (dissolve) has the cover, centroid and
    representative point of the same parts held in one multipolygon row."""
    from gridpanel.operators.geometry import region_names
    from gridpanel.operators.shapes import centroid, representative_point

    a = [(0, 0), (20, 0), (20, 20), (0, 20), (0, 0)]
    hole = [(5, 5), (8, 5), (8, 8), (5, 8), (5, 5)]
    b = [(40, -10), (44, -10), (44, 30), (40, 30), (40, -10)]
    c = [(10, 10), (30, 10), (30, 15), (10, 15), (10, 10)]          # overlaps a
    rows = regions_df(spark, [(7, "m", [poly(b)]), (3, "m", [poly(a, hole)]), (9, "m", [poly(c)]),
                              (4, "n", [poly(b)])])
    d = dissolve_by_name(rows)
    one = regions_df(spark, [(3, "m", [poly(a, hole), poly(b), poly(c)]), (4, "n", [poly(b)])])
    assert sorted(tuple(r) for r in region_names(d).collect()) == [(3, "m"), (4, "n")]
    for buf in (0.0, 300000.0):
        assert set(cells(buffered_cover(region_edges(d), G, buf))) == \
            set(cells(buffered_cover(region_edges(one), G, buf)))
    # centroid: area-weighted over rows (non-overlapping parts only)
    nov = dissolve_by_name(rows.where("region_id != 9"))
    one_nov = regions_df(spark, [(3, "m", [poly(a, hole), poly(b)]), (4, "n", [poly(b)])])
    got = {r["region_id"]: (r["cx"], r["cy"]) for r in centroid(nov).collect()}
    want = {r["region_id"]: (r["cx"], r["cy"]) for r in centroid(one_nov).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert abs(got[k][0] - want[k][0]) < 1e-9 and abs(got[k][1] - want[k][1]) < 1e-9
    got = {r["region_id"]: (r["rx"], r["ry"]) for r in representative_point(d).collect()}
    want = {r["region_id"]: (r["rx"], r["ry"]) for r in representative_point(one).collect()}
    assert got == want


def test_random_polygons_match_brute_force(spark):
    """60 random simple and self-crossing polygons (3-7 vertices, some with holes),
    containment and 250 km buffer, against per-node brute force."""
    import random

    rnd = random.Random(7)
    rows, shapes = [], {}
    for rid in range(60):
        cx, cy = rnd.uniform(-170, 170), rnd.uniform(-70, 70)
        n = rnd.randint(3, 7)
        ring = [(cx + rnd.uniform(-15, 15), cy + rnd.uniform(-12, 12)) for _ in range(n)]
        ring.append(ring[0])
        rings = [ring]
        if rid % 4 == 0:
            hole = [(cx - 2, cy - 2), (cx + 2, cy - 2), (cx + 2, cy + 2), (cx - 2, cy + 2), (cx - 2, cy - 2)]
            rings.append(hole)
        shapes[rid] = rings
        rows.append((rid, f"r{rid}", [poly(*rings)]))
    df = regions_df(spark, rows)
    e = region_edges(df)
    inside = set(cells(scanline_cover(e, G)))
    expect = {(rid, G.lat0 + G.dlat * r, G.lon0 + G.dlon * c)
              for rid, rings in shapes.items() for r in range(G.nlat) for c in range(G.nlon)
              if brute_inside(rings, G.lat0 + G.dlat * r, G.lon0 + G.dlon * c)}
    assert inside == expect
    buffered = set(cells(buffered_cover(e, G, 250000.0)))
    expect_b = set()
    for rid, rings in shapes.items():
        expect_b |= set(brute_buffer(rid, rings, 250000.0))
    assert buffered == expect_b
