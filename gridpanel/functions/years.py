"""Year sets: parse a spec, turn it into a table, test membership, extract from paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR_IN_PATH = r"year=(\d{4})"


_RANGE = re.compile(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?")


def parse_year_spec(spec: str, lists: bool = True) -> list[int]:
    """Sorted years of ``"2000-2003"`` (both ends), ``"2000,2002"`` or ``"2000"``; a list may
    hold ranges. With ``lists=False`` a single year or range is all that is allowed."""
    years: set[int] = set()
    for item in spec.split(",") if lists else [spec]:
        m = _RANGE.fullmatch(item)
        if m:
            years.update(range(int(m[1]), int(m[2] or m[1]) + 1))
        elif item.strip() or not lists:
            raise ValueError(f"not a year or a range of years: {item!r}")
    return sorted(years)


def years_df(spark: SparkSession, years: list[int] | str) -> DataFrame:
    ys = parse_year_spec(years) if isinstance(years, str) else sorted(set(years))
    return spark.createDataFrame([(y,) for y in ys], "year int")


def year_from_path(path: Column) -> Column:
    """Year from a ``year=YYYY`` path segment; NULL when the path has none."""
    y = F.regexp_extract(path, YEAR_IN_PATH, 1)
    return F.when(y == "", F.lit(None)).otherwise(y.cast("int"))


def years_missing(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested years that are not among the landed ones: what an incremental run must
    load. Give it the valid rows of ``landed_partition_report`` to load broken years again."""
    return requested.join(landed.select("year").distinct(), "year", "left_anti")


def years_outside(result: DataFrame, requested: DataFrame) -> DataFrame:
    """Years present in a result but not requested."""
    return result.select("year").distinct().join(requested, "year", "left_anti")


def last_years(end_year: int, n: int = 2) -> str:
    """Range spec of the ``n`` years up to ``end_year``."""
    return f"{end_year - n + 1}-{end_year}"
