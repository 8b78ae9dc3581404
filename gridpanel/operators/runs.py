"""Regional means over runs of columns: work grows with the outline, not with the area.

A cover is kept as runs (region, grid row, first column, last column). Along each grid row
of a time step running sums are taken once, and a run's sum is the running sum at its last
column less the one before its first. Only the ends of runs meet the facts: they are put
into the row's cells as marks, one window over the row adds up, and the marks that come
out carry the sums. A region of a million cells and a thousand rows costs two thousand
marks a time step.

The weight is the same along a grid row, so sums are of plain values, and counts are whole
numbers; a difference of sums is off by rounding of the row's sum (some 1e-13 of it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geodesy import area_weight
from ..sources.grid import GridSpec, with_cell_keys
from .cover import scanline_crossings
from .joins import sized_broadcast


def _merged(runs: DataFrame) -> DataFrame:
    """Runs of a region and row that overlap or touch become one (parts may overlap)."""
    by = Window.partitionBy("region_id", "ilat").orderBy("c0", "c1")
    reach = F.max("c1").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = (reach.isNull() | (F.col("c0") > reach + 1)).cast("int")
    numbered = runs.withColumn("new", new).withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("region_id", "ilat", "run").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("run")


def scanline_runs(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Columns inside a region as disjoint runs ``region_id, ilat, c0, c1`` (both ends
    included): the cells of ``scanline_cover``, without a row for each."""
    crossings = scanline_crossings(edges, grid).repartition("region_id", "ilat")
    along = Window.partitionBy("region_id", "part_id", "ilat").orderBy("x")
    pairs = (crossings.withColumn("k", F.row_number().over(along)).withColumn("xb", F.lead("x").over(along))
             .where((F.col("k") % 2 == 1) & F.col("xb").isNotNull()))

    def column_at(x):
        return F.ceil((x - F.lit(grid.lon0)) / F.lit(grid.dlon)).cast("int")

    # the arithmetic may be off by one, so the columns beside are tried with the exact test
    a, b = column_at(F.col("x")), column_at(F.col("xb"))
    first = F.coalesce(*[F.when(grid.lon_of(a + k) >= F.col("x"), a + k) for k in (-1, 0)], a + 1)
    last = F.coalesce(*[F.when(grid.lon_of(b + k) < F.col("xb"), b + k) for k in (0, -1)], b - 2)
    runs = pairs.select("region_id", "ilat", F.greatest(F.lit(0), first).alias("c0"),
                        F.least(F.lit(grid.nlon - 1), last).alias("c1"))
    return _merged(runs.where("c0 <= c1"))


def runs_of(cells: DataFrame) -> DataFrame:
    """The runs of any cover given cell by cell (``region_id, ilat, ilon``)."""
    return _merged(cells.select("region_id", "ilat", F.col("ilon").alias("c0"), F.col("ilon").alias("c1")))


def monthly_over_runs(facts: DataFrame, grid: GridSpec, runs: DataFrame, weighted: bool = True,
                      carry: list[str] | None = None) -> DataFrame:
    """``(region_id, *carry, year, time, mt)``: what ``spatial_agg.regional_monthly`` gives
    over the runs' cells. ``facts`` is the normalised table ``(time, year, lat, lon, v)``."""
    carry = carry or []
    cells = (with_cell_keys(facts, grid).groupBy("time", "year", "ilat", "ilon")
             .agg(F.sum("v").alias("s"), F.count("v").alias("n"), F.count("*").alias("r")))
    none = F.struct(*[F.lit(None).cast(runs.schema[c].dataType).alias(c) for c in ("region_id", *carry)])
    cell = F.struct(F.col("ilon").alias("col"), F.lit(0).alias("mark"), F.coalesce("s", F.lit(0.0)).alias("s"), "n", "r",
                    none.alias("of"))
    rows = cells.groupBy("time", "year", "ilat").agg(F.collect_list(cell).alias("cells"))   # a grid row: nlon at most
    of = F.struct("region_id", *carry)
    ends = runs.select("ilat", F.explode(F.array(
        F.struct(F.col("c1").alias("col"), F.lit(1).alias("mark")),
        F.struct((F.col("c0") - 1).alias("col"), F.lit(-1).alias("mark")))).alias("e"), of.alias("of"))
    mark = F.struct(F.col("e.col").alias("col"), F.col("e.mark").alias("mark"), F.lit(0.0).alias("s"),
                    F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("r"), "of")
    marks = sized_broadcast(ends.groupBy("ilat").agg(F.collect_list(mark).alias("marks")))
    swept = (rows.join(marks, "ilat").select("time", "year", "ilat", F.explode(F.concat("cells", "marks")).alias("c"))
             .select("time", "year", "ilat", "c.*"))
    # a mark counts the cells up to and with its column
    so_far = (Window.partitionBy("time", "year", "ilat").orderBy("col", F.abs("mark"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = swept.select("time", "year", "ilat", "mark", "of", *[F.sum(c).over(so_far).alias(c) for c in ("s", "n", "r")])
    w = area_weight(grid.lat_of(F.col("ilat"))) if weighted else F.lit(1.0)
    total = (at.where("mark <> 0").groupBy("of", "year", "time", "ilat")
             .agg(*[F.sum(F.col("mark") * F.col(c)).alias(c) for c in ("s", "n", "r")]))
    mean = F.try_divide(F.sum(F.when(F.col("n") > 0, w * F.col("s"))), F.sum(F.when(F.col("n") > 0, w * F.col("n"))))
    return (total.groupBy("of", "year", "time").agg(mean.alias("mt"), F.sum("r").alias("r")).where("r > 0")
            .select("of.*", "year", "time", "mt"))
