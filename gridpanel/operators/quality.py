"""Data-quality checks as DataFrames (one row per check) and schema-time guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geometry import is_empty_geometry

PLAUSIBLE_MIN_C = -60.0
PLAUSIBLE_MAX_C = 60.0


def check_columns(columns: list[str], required: set[str], source: str = "table") -> None:
    """The columns are exactly the required ones, in any order."""
    if odd := set(columns) ^ required:
        notes = [f"{c} ({'lacking' if c in required else 'not expected'})" for c in sorted(odd)]
        raise ValueError(f"{source} does not have the columns {sorted(required)}: {', '.join(notes)}")


def require_rows(df: DataFrame, what: str = "result") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"No rows in {what}")
    return df


def geometry_counts(regions: DataFrame, stage: str) -> DataFrame:
    """``stage, n_rows, n_null, n_empty, n_regions`` (distinct names) for a polygon table."""
    null = F.col("parts").isNull()
    return regions.agg(
        F.lit(stage).alias("stage"), F.count("*").alias("n_rows"),
        F.count_if(null).alias("n_null"),
        F.count_if(~null & is_empty_geometry(F.col("parts"))).alias("n_empty"),
        F.count_distinct("name").alias("n_regions"))


def out_of_range_flag(c, lo: float = PLAUSIBLE_MIN_C, hi: float = PLAUSIBLE_MAX_C):
    return (c < lo) | (c > hi)


def latest_year_stats(df: DataFrame, col: str = "temp_c") -> DataFrame:
    """Mean, min, max and sample standard deviation over the latest year's rows."""
    latest = df.select(F.max("year")).scalar()
    return df.where(F.col("year") == latest).agg(
        F.max("year").alias("year"), F.count("*").alias("n_rows"),
        F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
        F.stddev_samp(col).alias("std"))


def coverage_report(expected: DataFrame, annual: DataFrame, audit: DataFrame, requested_years: list[int],
                    source_years: DataFrame | None = None, polygons: DataFrame | None = None) -> DataFrame:
    """One row per check: ``check, severity, n, passed``.

    expected: region names; annual: (country, year, temp_c); audit: fallback audit;
    source_years: the years that are landed; polygons: one row per region polygon, whose
    number the regions must have. Missing countries and regions fail; missing source years,
    gaps, unexpected years and out-of-range temperatures warn. Checks whose table is not
    given are left out.

    One pass: all tables are tagged and put together, counted per country (pre-aggregated,
    so a large country costs a row a task), and the countries' counts are added up."""
    tagged = [
        expected.select(F.lit("expected").alias("tag"), F.col("name").alias("country")).distinct(),
        annual.select(F.lit("annual").alias("tag"), "country", "year", "temp_c"),
        audit.where(F.col("status") == "fallback_used").select(F.lit("fallback").alias("tag"), "country"),
        expected.select(F.lit("region").alias("tag"), F.col("name").alias("country")),
    ]
    if source_years is not None:
        tagged.append(source_years.select(F.lit("source").alias("tag"), F.col("year").cast("int").alias("year")))
    if polygons is not None:
        tagged.append(polygons.select(F.lit("polygon").alias("tag")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    years = F.array(*[F.lit(y) for y in requested_years])

    def has(tag):
        return F.col("tag") == tag

    wanted = F.array_contains(years, F.col("year"))
    per = rows.groupBy("country").agg(
        *[F.count_if(has(t)).alias(t) for t in ("expected", "annual", "fallback", "region", "polygon")],
        F.collect_set(F.when(has("annual") & wanted, F.col("year"))).alias("years"),
        F.collect_set(F.when(has("annual") & ~wanted, F.col("year"))).alias("others"),
        F.collect_set(F.when(has("source"), F.col("year"))).alias("sources"),
        F.count_if(has("annual") & out_of_range_flag(F.col("temp_c"))).alias("odd"))
    known, present, filled = F.col("expected") > 0, F.col("annual") > 0, F.col("fallback") > 0
    landed = F.flatten(F.collect_list("sources"))
    total = per.agg(
        F.count_if(known).alias("countries_expected"),
        F.count_if(present & ~filled).alias("direct_coverage"),
        F.count_if(filled).alias("fallback_used"),
        F.count_if(known & ~present).alias("missing_after_fallback"),
        F.sum(F.when(known, F.size(years) - F.size("years")).otherwise(0)).alias("country_years_missing"),
        F.size(F.array_distinct(F.flatten(F.collect_list("others")))).alias("years_outside_request"),
        F.sum("odd").alias("temp_out_of_range"),
        F.size(F.array_except(years, landed)).alias("source_years_missing"),
        F.abs(F.sum("region") - F.sum("polygon")).alias("regions_without_polygon"))
    checks = {"countries_expected": "info", "direct_coverage": "info", "fallback_used": "info",
              "missing_after_fallback": "error", "country_years_missing": "warn", "years_outside_request": "warn",
              "temp_out_of_range": "warn"}
    if source_years is not None:
        checks["source_years_missing"] = "warn"
    if polygons is not None:
        checks["regions_without_polygon"] = "error"
    out = [F.struct(F.lit(c).alias("check"), F.lit(severity).alias("severity"), F.col(c).cast("long").alias("n"),
                    (F.lit(severity == "info") | (F.col(c) == 0)).alias("passed")) for c, severity in checks.items()]
    return total.select(F.explode(F.array(*out)).alias("r")).select("r.*")
