"""Schema-time helpers: resolve column names, select what exists, rename, add typed nulls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values that must match the reference's results.
TIME_NAMES = ("time", "valid_time", "date", "datetime")
COUNTRY_NAME_CANDIDATES = ("ADMIN", "NAME", "name", "COUNTRY", "country")


def first_match(columns: list[str], *tests) -> str | None:
    """The first column that passes the first test which any column passes."""
    return next((c for test in tests for c in columns if test(c)), None)


def _named(name: str, fold: bool = False):
    return lambda c: (c.lower() if fold else c) == name


def _says_time(c: str) -> bool:
    return "time" in c.lower()


def resolve_time_column(columns: list[str]) -> str | None:
    """Time column: the known names in their order of priority, whatever their case,
    then any name that contains ``time``."""
    return first_match(columns, *(_named(n, fold=True) for n in TIME_NAMES), _says_time)


def resolve_time_column_in_order(columns: list[str]) -> str | None:
    """Variant: the frame's own order decides among the known names; without any time
    name it is the first column."""
    return first_match(columns, lambda c: c.lower() in TIME_NAMES, _says_time, lambda c: True)


def resolve_country_column(columns: list[str], explicit: str | None = None) -> str:
    """The configured name, which must exist, or the first known name (exact case)."""
    tests = [_named(n) for n in ([explicit] if explicit is not None else COUNTRY_NAME_CANDIDATES)]
    found = first_match(columns, *tests)
    if found is None:
        wanted = repr(explicit) if explicit is not None else f"any of {list(COUNTRY_NAME_CANDIDATES)}"
        raise ValueError(f"region names: {wanted} is not among the properties {columns}")
    return found


def resolve_id_column(df: DataFrame) -> DataFrame:
    """Indicator table with its code column named ``iso3`` (it may come as ``economy``)."""
    code = first_match(df.columns, _named("iso3"), _named("economy"))
    if code is None or "series" not in df.columns:
        raise KeyError(f"an indicator table has a code (iso3 or economy) and series; found {df.columns}")
    return df.withColumnRenamed(code, "iso3")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def select_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The subset of ``wanted`` that exists, in wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Fixed-schema view: cast present columns, add absent ones as typed NULLs, fix order."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])

