"""Country-year panel jobs: CO2 cleaning, indicator tidying, enrichment.

All three are DataFrame plans. Enrichment checkpoints each cleaned panel once
(they are small and read several times); the year-alignment maxima are a scalar
subquery over those checkpoints.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.util import inheritable_thread_target
from pyspark.sql import functions as F

from ..functions.columns import lower_columns, rename_existing, resolve_id_column, select_existing
from ..operators.clean import iso3_only, keep_iso3_year, require_not_null, year_range
from ..operators.names import add_iso3
from ..operators.reshape import melt_years, pivot_series
from ..operators.source_order import SOURCE_ORDER
from ..schemas import CO2_COLUMNS, CO2_RENAME, ERA5_KEEP, INDICATORS, OWID_KEEP, WB_KEEP


# -- C2: CO2 table ----------------------------------------------------------------

def clean_co2(raw: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """rename -> keep existing columns -> int year (NULL fails) -> upper iso3 -> length 3 ->
    drop ``OWID*`` -> inclusive year range (open end = no upper bound)."""
    df = select_existing(rename_existing(raw, CO2_RENAME), CO2_COLUMNS)
    df = require_not_null(df.withColumn("year", F.col("year").cast("int")), "year")
    df = iso3_only(df, "iso3", upper=True, drop_owid=True)
    return year_range(df, start, end)


# -- C3: indicators ---------------------------------------------------------------

def tidy_indicators(wide: DataFrame, indicators: dict[str, str] = INDICATORS,
                    exclude_codes: list[str] | None = None) -> DataFrame:
    """Wide-by-year indicator table -> ``iso3, year, <one column per indicator>``.

    lower-case names -> resolve id column -> 3-letter codes (not upper-cased) ->
    melt ``yrYYYY`` -> pivot series (first non-NULL, in input order where the table has
    the rows' places) -> short names."""
    df = resolve_id_column(lower_columns(wide))
    df = iso3_only(df.dropna(subset=["iso3"]), "iso3", upper=False, exclude=exclude_codes)
    placed = [SOURCE_ORDER] if SOURCE_ORDER in df.columns else []
    long_ = melt_years(df, ["iso3", "series", *placed])
    wide_ = pivot_series(long_, ["iso3", "year"], "series", list(indicators), order_col=SOURCE_ORDER if placed else None)
    wide_ = rename_existing(wide_, indicators)
    return select_existing(wide_, WB_KEEP)


def melt_indicators(wide: DataFrame) -> DataFrame:
    df = resolve_id_column(lower_columns(wide))
    df = iso3_only(df.dropna(subset=["iso3"]), "iso3", upper=False)
    return melt_years(df, ["iso3", "series"])


# -- C4: enrichment -----------------------------------------------------------------

def max_common_year(*panels: DataFrame):
    """min over panels of max(year), as one scalar-subquery Column (no driver round
    trip). The maxima are a union inside a single subquery, so the panels are
    evaluated by concurrent stages of one job."""
    maxes = [p.select(F.max("year").alias("m")) for p in panels]
    u = maxes[0]
    for m in maxes[1:]:
        u = u.unionByName(m)
    return u.select(F.min("m")).scalar()


def align_years(panels: list[DataFrame]) -> list[DataFrame]:
    cap = max_common_year(*panels)
    return [p.where(F.col("year") <= cap) for p in panels]


def prepare_panels(era5: DataFrame, owid: DataFrame, wb: DataFrame) -> list[DataFrame]:
    """Clean each panel to one row per (iso3, year) and checkpoint it.

    A panel is a code x year table, bounded by codes x years however large its
    inputs are, while computing it may scan the whole grid. Each is read several
    times (distinct names for the code lookup, the alignment scalar, the join),
    so it is computed once and written to the shared checkpoint folder; the
    readers then see only the small result. The three panels are independent
    jobs, submitted from three driver threads so that they share the executors
    instead of queueing. ``era5`` gets iso3 codes from its country names when it
    has none; temperature collisions (two names mapping to one code) keep the
    alphabetically first name."""
    def temperature() -> DataFrame:
        t = era5
        if "iso3" not in t.columns:
            t = add_iso3(t.checkpoint(), "country", "iso3")
        return keep_iso3_year(t, ["country"] if "country" in t.columns else None).checkpoint()

    jobs = [temperature, lambda: keep_iso3_year(owid).checkpoint(),
            lambda: keep_iso3_year(wb).checkpoint()]
    # wrapped here, in the caller's thread: the jobs inherit its local properties
    # (job group, scheduler pool, description, tags), so they can be tracked and cancelled
    with ThreadPoolExecutor(max_workers=3) as pool:
        wrap = inheritable_thread_target(era5.sparkSession)
        futures = [pool.submit(wrap(j)) for j in jobs]
        return [f.result() for f in futures]


def unmapped_countries(era5: DataFrame) -> DataFrame:
    """Country names that enrichment loses because they have no code, in order."""
    from ..operators.names import unmapped_names

    return unmapped_names(add_iso3(era5.select("country").distinct(), "country", "iso3"))


def enrich(era5: DataFrame, owid: DataFrame, wb: DataFrame) -> DataFrame:
    """Temperature x CO2 x indicators on (iso3, year), inner joins of the
    prepared panels after year alignment."""
    era5, owid, wb = align_years(prepare_panels(era5, owid, wb))
    era5 = select_existing(era5, ERA5_KEEP)
    owid = select_existing(owid, OWID_KEEP)
    wb = select_existing(wb, WB_KEEP)
    return reduce(lambda a, b: a.join(b, ["iso3", "year"], "inner"), [era5, owid, wb])
