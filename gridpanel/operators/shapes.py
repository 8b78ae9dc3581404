"""Per-region shape metrics computed inside each row with array functions.

A region row carries its whole outline, so centroid and representative point
are pure projections (no shuffle); the cost is linear in the region's vertices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _segments(ring: Column) -> Column:
    """Array of (a, b) vertex pairs of a closed ring."""
    return F.transform(F.sequence(F.lit(1), F.size(ring) - 1),
                       lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i + 1).alias("b")))


def _ring_sums(ring: Column) -> Column:
    """struct(s, mx, my): shoelace sums of a ring (s = twice the signed area)."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def step(acc, seg):
        a, b = seg["a"], seg["b"]
        cross = a["lon"] * b["lat"] - b["lon"] * a["lat"]
        return F.struct((acc["s"] + cross).alias("s"),
                        (acc["mx"] + (a["lon"] + b["lon"]) * cross).alias("mx"),
                        (acc["my"] + (a["lat"] + b["lat"]) * cross).alias("my"))

    return F.aggregate(_segments(ring), zero, step)


def centroid(regions: DataFrame) -> DataFrame:
    """Area centroid ``(region_id, cx, cy)``: shells add, holes subtract, whatever
    the ring orientation; parts of a multipolygon are area-weighted."""
    def ring_terms(part):
        return F.transform(part, lambda ring, j: F.struct(
            F.when(j == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("f"), _ring_sums(ring).alias("r")))

    terms = F.flatten(F.transform(F.col("parts"), ring_terms))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def acc(z, t):
        sg = t["f"] * F.signum(t["r"]["s"])
        return F.struct((z["a"] + sg * t["r"]["s"]).alias("a"), (z["mx"] + sg * t["r"]["mx"]).alias("mx"),
                        (z["my"] + sg * t["r"]["my"]).alias("my"))

    tot = F.aggregate(terms, zero, acc)
    t = regions.select("region_id", tot["a"].alias("a"), tot["mx"].alias("mx"), tot["my"].alias("my"))
    if "src_id" in regions.columns:
        # a dissolved region spans several rows: its centroid is the area-weighted
        # combination of the rows' sums (a partial aggregate, no gathering of rows)
        t = t.groupBy("region_id").agg(F.sum("a").alias("a"), F.sum("mx").alias("mx"),
                                       F.sum("my").alias("my"))
    return t.select("region_id", (F.col("mx") / (F.lit(3.0) * F.col("a"))).alias("cx"),
                    (F.col("my") / (F.lit(3.0) * F.col("a"))).alias("cy"))


def _part_scan(part: Column) -> Column:
    """struct(part, y): the polygon with its scan-line latitude."""
    ys = F.transform(F.flatten(part), lambda p: p["lat"])
    ext = F.struct(F.array_min(ys).alias("lo"), F.array_max(ys).alias("hi"))

    def pick(e):
        centre = (e["lo"] + e["hi"]) / 2.0
        lo = F.array_max(F.filter(ys, lambda y: y <= centre))
        hi = F.coalesce(F.array_min(F.filter(ys, lambda y: y > centre)), e["hi"])
        return (lo + hi) / 2.0

    # ``ext`` is evaluated once per polygon by passing it through a one-element array
    y = F.element_at(F.transform(F.array(ext), pick), 1)
    return F.struct(part.alias("part"), y.alias("y"))


def _part_crossings(s: Column) -> Column:
    """struct(xs, y, x0, y0): sorted crossings of all rings with the scan line
    (half-open rule) plus the polygon's first vertex."""
    Y = s["y"]

    def crossings(ring):
        segs = F.filter(_segments(ring), lambda g: (g["a"]["lat"] != g["b"]["lat"]) & (
            F.least(g["a"]["lat"], g["b"]["lat"]) <= Y) & (Y < F.greatest(g["a"]["lat"], g["b"]["lat"])))
        return F.transform(segs, lambda g: F.when(
            g["a"]["lon"] == g["b"]["lon"], g["a"]["lon"]).otherwise(
            g["a"]["lon"] + (Y - g["a"]["lat"]) / ((g["b"]["lat"] - g["a"]["lat"]) / (g["b"]["lon"] - g["a"]["lon"]))))

    first = F.element_at(F.element_at(s["part"], 1), 1)
    return F.struct(F.array_sort(F.flatten(F.transform(s["part"], crossings))).alias("xs"), Y.alias("y"),
                    first["lon"].alias("x0"), first["lat"].alias("y0"))


def _part_best(c: Column) -> Column:
    """struct(width, x, y): midpoint of the widest interior interval (first in x
    order on ties); a polygon the line does not cross keeps its first vertex."""
    xs = c["xs"]
    n_pairs = (F.size(xs) / 2).cast("int")
    ivals = F.transform(F.sequence(F.lit(0), F.greatest(n_pairs - 1, F.lit(0))), lambda k: F.struct(
        (F.element_at(xs, 2 * k + 2) - F.element_at(xs, 2 * k + 1)).alias("width"),
        ((F.element_at(xs, 2 * k + 1) + F.element_at(xs, 2 * k + 2)) / 2.0).alias("x")))
    init = F.struct(F.lit(0.0).alias("width"), c["x0"].alias("x"), c["y0"].alias("y"))
    return F.aggregate(
        F.when(n_pairs > 0, ivals).otherwise(F.array().cast("array<struct<width:double,x:double>>")),
        init,
        lambda acc, iv: F.when(iv["width"] > acc["width"],
                               F.struct(iv["width"].alias("width"), iv["x"].alias("x"), c["y"].alias("y")))
        .otherwise(acc))


def representative_point(regions: DataFrame) -> DataFrame:
    """A point guaranteed inside each region: ``(region_id, rx, ry)``; across
    parts the widest scan interval wins (first part on ties).

    Computed in three projections so that each per-polygon intermediate (scan
    line, sorted crossings) is materialised once instead of being re-derived at
    every reference inside the lambdas."""
    src = ["src_id"] if "src_id" in regions.columns else []
    a = regions.select("region_id", *src, F.transform(F.col("parts"), _part_scan).alias("_s"))
    b = a.select("region_id", *src, F.transform(F.col("_s"), _part_crossings).alias("_c"))
    c = b.select("region_id", *src, F.transform(F.col("_c"), _part_best).alias("_p"))
    init = F.struct(F.lit(-1.0).alias("width"), F.lit(None).cast("double").alias("x"),
                    F.lit(None).cast("double").alias("y"))
    best = F.aggregate(F.col("_p"), init, lambda acc, p: F.when(p["width"] > acc["width"], p).otherwise(acc))
    if not src:
        return c.select("region_id", best["x"].alias("rx"), best["y"].alias("ry"))
    # a dissolved region spans several rows: the widest interval over all rows wins,
    # the row with the smallest source id on ties (a partial aggregate)
    r = c.select("region_id", "src_id", best.alias("b"))
    pick = F.max_by(F.struct(F.col("b.x").alias("x"), F.col("b.y").alias("y")),
                    F.struct(F.col("b.width"), (-F.col("src_id")).alias("first")))
    out = r.groupBy("region_id").agg(pick.alias("p"))
    return out.select("region_id", F.col("p.x").alias("rx"), F.col("p.y").alias("ry"))
