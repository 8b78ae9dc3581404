"""Publish the annual temperature partitions as one CSV, plus run statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import conform
from ..operators.clean import require_not_null
from ..operators.dedup import keep_first
from ..operators.quality import require_rows
from ..operators.source_order import SOURCE_ORDER, with_source_order
from ..schemas import ANNUAL_TEMP
from ..sinks.files import write_single_csv, write_success_marker
from ..sources.footers import partition_files

#: Columns of every file, and their types; the year is in the path.
REQUIRED = {f.name: f.dataType.simpleString() for f in ANNUAL_TEMP.fields if f.name != "year"}
KEYS = ["country", "year"]


@dataclass
class PublishStats:
    n_partitions: int
    n_countries: int
    n_rows: int
    y_min: int | None
    y_max: int | None


def within(min_year: int | None, max_year: int | None):
    """The year is in the closed range (None: open end)."""
    year = F.col("year")
    return (F.lit(True) if min_year is None else year >= min_year) & (F.lit(True) if max_year is None else year <= max_year)


def load_partitions(spark: SparkSession, base_dir: str, min_year: int | None = None,
                    max_year: int | None = None, ordered: bool = False) -> DataFrame:
    """Year-partitioned table restricted to [min_year, max_year] on the *path's* year
    (partition pruning). Every file of these partitions must have the exact columns and
    types: their footers are read by the executors, and the driver sees a row per year.
    ``ordered`` adds the rows' place in the files."""
    files = partition_files(spark, base_dir, REQUIRED).where(within(min_year, max_year))
    odd = F.when(F.size("problems") > 0, F.concat(F.col("path"), F.lit(": "), F.array_join("problems", ", ")))
    years = files.groupBy("year").agg(F.count(odd).alias("n_odd"), F.min(odd).alias("example")).orderBy("year").collect()
    if not years:
        raise ValueError(f"No rows in {base_dir}: no year from {min_year} to {max_year}")
    if bad := [r for r in years if r.n_odd]:
        raise ValueError(f"{sum(r.n_odd for r in bad)} files do not have the columns {sorted([*REQUIRED, 'year'])}: "
                         + "; ".join(r.example for r in bad[:20]))
    # only the year=YYYY folders (there may be e.g. an audit CSV beside them)
    df = spark.read.schema(ANNUAL_TEMP).option("basePath", base_dir).parquet(f"{base_dir.rstrip('/')}/year=*")
    if ordered:
        df = with_source_order(df)
    df = df.where(within(min_year, max_year))
    for key in KEYS:
        df = require_not_null(df, key)
    wanted = ANNUAL_TEMP.fields + ([df.schema[SOURCE_ORDER]] if ordered else [])
    return conform(df, StructType(wanted))


def first_rows(df: DataFrame) -> DataFrame:
    """Of the rows of a (country, year) the first in input order (``ordered`` tables)."""
    return keep_first(df, KEYS, [SOURCE_ORDER]).drop(SOURCE_ORDER)


def publish_rows(df: DataFrame) -> DataFrame:
    """Keep-first per (country, year) in input order (rows without a place: the coldest) and
    sort by (country, year), nulls last."""
    dedup = first_rows(df) if SOURCE_ORDER in df.columns else keep_first(df, KEYS, ["temp_c"])
    return dedup.orderBy(F.col("country").asc_nulls_last(), F.col("year").asc_nulls_last())


def publish_stats(df: DataFrame) -> DataFrame:
    """``n_partitions, n_countries, n_rows, y_min, y_max`` in one aggregate."""
    return df.agg(F.count_distinct("year").alias("n_partitions"),
                  F.count_distinct("country").alias("n_countries"),
                  F.count("*").alias("n_rows"),
                  F.min("year").alias("y_min"), F.max("year").alias("y_max"))


def publish(spark: SparkSession, base_dir: str, out_csv: str, min_year: int | None = None,
            max_year: int | None = None, success_marker: str | None = None) -> PublishStats:
    df = load_partitions(spark, base_dir, min_year, max_year, ordered=True)
    rows = first_rows(require_rows(df, "publish after filtering"))
    write_single_csv(rows, out_csv, sort=["country", "year"])
    if success_marker:
        write_success_marker(spark, success_marker)
    s = publish_stats(spark.read.option("header", True).schema(ANNUAL_TEMP).csv(out_csv)).first()
    return PublishStats(s["n_partitions"], s["n_countries"], s["n_rows"], s["y_min"], s["y_max"])
