"""Two-level means: weights, NULL cells, overlaps, constant fields."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import poly, regions_df
from gridpanel.plans.annual import annual_means, direct_annual_means
from gridpanel.sources.grid import GridSpec

G = GridSpec(lat0=-90.0, dlat=5.0, nlat=37, lon0=-180.0, dlon=5.0, nlon=72)
SCHEMA = "time timestamp, year int, lat double, lon double, v double"


def facts(spark, rows):
    import datetime as dt

    return spark.createDataFrame([(dt.datetime(y, m, 1), y, la, lo, v) for y, m, la, lo, v in rows], SCHEMA)


def box(lon0, lat0, lon1, lat1):
    return poly([(lon0, lat0), (lon1, lat0), (lon1, lat1), (lon0, lat1), (lon0, lat0)])


def test_weights_and_null_cells(spark):
    # cells at lat 0 (w=1) and lat 60 (w=0.5); a NULL cell at lat 30 adds no weight
    f = facts(spark, [(2000, 1, 0.0, 0.0, 10.0), (2000, 1, 60.0, 0.0, 40.0), (2000, 1, 30.0, 0.0, None)])
    r = regions_df(spark, [(1, "a", [box(-1, -1, 1, 61)])])
    out = direct_annual_means(f, r, G).collect()
    assert len(out) == 1
    assert out[0]["temp_c"] == pytest.approx((10 * 1 + 40 * 0.5) / 1.5)


def test_two_level_not_pooled(spark):
    # month 1 has two cells, month 2 one cell: annual = mean of monthly means
    f = facts(spark, [(2000, 1, 0.0, 0.0, 0.0), (2000, 1, 0.0, 5.0, 10.0), (2000, 2, 0.0, 0.0, 20.0)])
    r = regions_df(spark, [(1, "a", [box(-1, -1, 6, 1)])])
    out = direct_annual_means(f, r, G, weighted=False).collect()
    assert out[0]["temp_c"] == pytest.approx((5.0 + 20.0) / 2)


def test_overlapping_regions_share_cells(spark):
    f = facts(spark, [(2000, 1, 0.0, 0.0, 1.0), (2000, 1, 0.0, 5.0, 3.0)])
    r = regions_df(spark, [(1, "a", [box(-1, -1, 6, 1)]), (2, "b", [box(4, -1, 6, 1)])])
    out = {x["country"]: x["temp_c"] for x in direct_annual_means(f, r, G).collect()}
    assert out == {"a": pytest.approx(2.0), "b": pytest.approx(3.0)}


def test_constant_field(spark):
    rows = [(2001, m, la, lo, 7.5) for m in (1, 2, 3) for la in (-10.0, 0.0, 40.0) for lo in (0.0, 5.0, 10.0)]
    r = regions_df(spark, [(1, "a", [box(-2, -12, 12, 42)])])
    out = direct_annual_means(facts(spark, rows), r, G).collect()
    assert out[0]["temp_c"] == pytest.approx(7.5)


def test_null_only_region_keeps_row_and_gets_no_fallback(spark):
    f = facts(spark, [(2000, 1, 0.0, 0.0, None), (2000, 1, 20.0, 20.0, 5.0)])
    r = regions_df(spark, [(1, "nulls", [box(-1, -1, 1, 1)])])
    annual, audit = annual_means(f, r, G, buffer_m=0.0, cap_km=10000.0)
    rows = annual.collect()
    assert len(rows) == 1 and rows[0]["temp_c"] is None
    assert audit.count() == 0


def test_fallback_cap_and_ties(spark):
    # tiny box centred at (2.5, 0): equidistant from nodes (0, 0) and (5, 0)
    f = facts(spark, [(2000, 1, 0.0, 0.0, 1.0), (2000, 1, 0.0, 5.0, 2.0), (2000, 1, 50.0, 50.0, 9.0)])
    tiny = regions_df(spark, [(1, "tiny", [box(2.4, -0.1, 2.6, 0.1)])])
    annual, audit = annual_means(f, tiny, G, buffer_m=0.0, cap_km=500.0)
    a = audit.collect()[0]
    assert a["status"] == "fallback_used" and (a["near_lat"], a["near_lon"]) == (0.0, 0.0)
    assert annual.collect()[0]["temp_c"] == pytest.approx(1.0)
    # equal to the cap is accepted, beyond is audited with the true distance
    d = a["min_km"]
    _, at_cap = annual_means(f, tiny, G, buffer_m=0.0, cap_km=d)
    assert at_cap.collect()[0]["status"] == "fallback_used"
    ann2, below = annual_means(f, tiny, G, buffer_m=0.0, cap_km=d - 1e-6)
    b = below.collect()[0]
    assert b["status"] == f"no_cell_within_{d - 1e-6!r}km" and b["min_km"] == pytest.approx(d)
    assert b["near_lat"] is None and ann2.count() == 0


def test_grid_spec_from_fixture_facts(spark):
    from gridpanel.plans.catalog import facts_of
    from gridpanel.sources.fixtures import fixture_grid

    assert GridSpec.from_facts(facts_of(spark, "/root/testdata/sf0.001")) == fixture_grid()


def _shuffle_records(plan) -> list[int]:
    """Records written by every shuffle of an executed (adaptive) plan."""
    out = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(plan)
    return out


def test_hot_region_is_preaggregated_before_the_shuffle(spark):
    """One region holds a third of all fact rows: the spatial mean's shuffle still
    carries at most one partial row per (task, region, month), not the hot rows."""
    from gridpanel.operators.spatial_agg import regional_monthly
    from gridpanel.plans.annual import region_cover
    from gridpanel.sources.grid import with_cell_keys

    n, tasks = 120_000, 8
    ids = spark.range(0, n, numPartitions=tasks)
    ilat, ilon = F.col("id") % 37, (F.col("id") * 7) % 72
    f = ids.select(F.make_timestamp(F.lit(2000), F.col("id") % 12 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
                   .alias("time"), F.lit(2000).alias("year"),
                   (F.lit(-90.0) + F.lit(5.0) * ilat).alias("lat"), (F.lit(-180.0) + F.lit(5.0) * ilon).alias("lon"),
                   (F.col("id") % 97).cast("double").alias("v"))
    # region 0: every longitude of the southern rows (a third of the globe's nodes);
    # regions 1..20: small boxes elsewhere
    rows = [(0, "hot", [box(-182.5, -92.5, 177.5, -27.5)])]
    rows += [(k, f"r{k}", [box(-180 + 15 * k, 10, -170 + 15 * k, 20)]) for k in range(1, 21)]
    regions = regions_df(spark, rows)
    cover = F.broadcast(region_cover(regions, G))
    keyed = with_cell_keys(f, G)
    hot_rows = keyed.join(cover.where("region_id = 0"), ["ilat", "ilon"]).count()
    assert hot_rows >= n // 3
    m = regional_monthly(keyed, cover)
    m.collect()
    written = _shuffle_records(m._jdf.queryExecution().executedPlan())
    assert written and 0 < sum(written) <= tasks * len(rows) * 12 < hot_rows, (written, hot_rows)
