"""Row filters and casts used by the ingest jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first


def iso3_only(df: DataFrame, col: str = "iso3", upper: bool = True, drop_owid: bool = False,
              exclude: list[str] | None = None) -> DataFrame:
    """Keep rows whose code is exactly three characters (NULL codes drop out).

    ``upper`` upper-cases first (the length test then sees the upper-cased code);
    ``drop_owid`` also removes ``OWID*`` aggregates; ``exclude`` optionally lists
    aggregate codes that are three letters long (WLD, EUU, ...)."""
    c = F.upper(F.col(col)) if upper else F.col(col)
    out = df.withColumn(col, c).where(F.length(col) == 3)
    if drop_owid:
        out = out.where(~F.col(col).startswith("OWID"))
    if exclude:
        out = out.where(~F.col(col).isin(exclude))
    return out


def year_range(df: DataFrame, start: int | None, end: int | None, col: str = "year") -> DataFrame:
    """Inclusive bounds; an open bound is not applied (an open end means "up to the
    data's latest year", which every row satisfies)."""
    if start is not None:
        df = df.where(F.col(col) >= start)
    if end is not None:
        df = df.where(F.col(col) <= end)
    return df


def require_not_null(df: DataFrame, col: str) -> DataFrame:
    """Fail the job (not the driver) when a required column holds NULL."""
    return df.withColumn(col, F.when(F.col(col).isNull(),
                                     F.raise_error(F.lit(f"NULL in required column {col}")))
                         .otherwise(F.col(col)))


def keep_iso3_year(df: DataFrame, order: list | None = None) -> DataFrame:
    """Composite clean: drop NULL iso3 -> upper -> length 3 -> int year (NULL fails) -> keep-first
    per (iso3, year). ``order`` is the explicit keep-first order (default: all
    other columns ascending)."""
    if "iso3" not in df.columns:
        raise KeyError("keep_iso3_year needs an iso3 column")
    out = iso3_only(df.dropna(subset=["iso3"]), "iso3", upper=True)
    out = require_not_null(out.withColumn("year", F.col("year").cast("int")), "year")
    return keep_first(out, ["iso3", "year"], order)
