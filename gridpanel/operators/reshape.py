"""Wide <-> long reshapes of indicator tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def year_columns(df: DataFrame, prefix: str = "yr") -> list[str]:
    """Columns named like ``yrYYYY`` (any suffix after the prefix is accepted; bad
    suffixes become NULL years in ``melt_years``)."""
    return [c for c in df.columns if c.startswith(prefix)]


def melt_years(df: DataFrame, ids: list[str], prefix: str = "yr") -> DataFrame:
    """``(ids..., year, value)`` from ``prefixYYYY`` columns; year parsed leniently, values
    that are NaN or not a number are NULL."""
    cols = year_columns(df, prefix)
    if not cols:
        raise KeyError(f"no {prefix}YYYY columns in {df.columns}")
    def number(c):
        v = F.expr(f"try_cast(`{c}` as double)")
        return F.when(~F.isnan(v), v).alias(c)

    long_ = df.select(*ids, *[number(c) for c in cols]).unpivot(
        ids, cols, "year_label", "value")
    year = F.expr(f"try_cast(regexp_replace(year_label, '^{re.escape(prefix)}', '') as int)")
    return long_.select(*ids, year.alias("year"), "value")


def pivot_series(long_: DataFrame, index: list[str], series_col: str, values: list[str],
                 value_col: str = "value", order_col: str | None = None) -> DataFrame:
    """One column per series value: the non-NULL value of each cell, of several the first
    by ``order_col`` (without one the smallest, whatever the rows' order); index keys with
    no non-NULL value at all are absent; NULL index keys are dropped.

    The pivot values are given, so no extra pass collects them."""
    src = long_.where(F.col(value_col).isNotNull())
    for k in index:
        src = src.where(F.col(k).isNotNull())
    return (src.groupBy(*index).pivot(series_col, values)
            .agg(F.min(value_col) if order_col is None else F.min_by(value_col, order_col)))


def grid_mesh(spark, nlat: int, nlon: int, lat_of, lon_of) -> DataFrame:
    """All (lat, lon) nodes of a regular grid from one ``range``: flat index ->
    (row, col) by ``idx div nlon`` and ``idx mod nlon``."""
    idx = spark.range(nlat * nlon)
    r, c = (F.col("id") / nlon).cast("long"), F.pmod(F.col("id"), F.lit(nlon))
    return idx.select(F.col("id").alias("idx"), r.cast("int").alias("ilat"), c.cast("int").alias("ilon")) \
        .withColumn("lat", lat_of(F.col("ilat"))).withColumn("lon", lon_of(F.col("ilon")))
