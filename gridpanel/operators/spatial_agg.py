"""Regional means over a grid: cover join + two-level aggregation.

Level 1 (space): per (region, time) mean over the region's cells, optionally
cos(lat)-weighted; NULL cells are excluded from numerator and denominator, and a
region-time whose cells are all NULL yields a NULL mean (the row is kept).
Level 2 (time): per (region, year) unweighted mean of the monthly means, NULLs
skipped.

Both levels are hash aggregates with map-side partial aggregation, so a region
holding a large share of all cells costs one partial row per task, not a hot
shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import area_weight


def regional_monthly(facts: DataFrame, cover: DataFrame, weighted: bool = True,
                     key: str = "region_id", carry: list[str] | None = None) -> DataFrame:
    """``(key, *carry, year, time, mt)``; ``facts`` carries ``ilat, ilon, lat, time, year, v``.

    ``cover`` should already carry a broadcast hint when its size is bounded
    (see ``joins.sized_broadcast``); otherwise this is a shuffle join on the cell key.
    ``carry`` are cover columns that depend on ``key`` only (kept as grouping keys,
    which does not change the groups).
    """
    carry = carry or []
    j = facts.select("ilat", "ilon", "lat", "time", "year", "v").join(cover, ["ilat", "ilon"])
    if weighted:
        w = area_weight(F.col("lat"))
        mt = F.try_divide(F.sum(w * F.col("v")), F.sum(F.when(F.col("v").isNotNull(), w)))
    else:
        mt = F.avg("v")
    return j.groupBy(key, *carry, "year", "time").agg(mt.alias("mt"))


def annual_from_monthly(monthly: DataFrame, key: str = "region_id",
                        carry: list[str] | None = None) -> DataFrame:
    """``(key, *carry, year, temp_c)``: unweighted mean over the months of each year."""
    return monthly.groupBy(key, *(carry or []), "year").agg(F.avg("mt").alias("temp_c"))
