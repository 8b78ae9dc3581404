"""Tabular sources: raw CSV panels, indicator tables, year-partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.years import year_from_path
from ..operators.source_order import with_line_order, with_source_order
from .footers import partition_files

# Raw CO2 columns used downstream and their types; every other column is ignored.
CO2_RAW_TYPES = {
    "iso_code": "string",
    "country": "string",
    "year": "int",
    "co2": "double",
    "co2_per_capita": "double",
    "share_global_co2": "double",
    "consumption_co2": "double",
}


def _typed(col: str, t: str):
    v = F.col(f"`{col}`")
    if t == "string":
        return v
    cast = F.expr(f"try_cast(`{col}` as {t})")
    if t == "int":      # pandas may have written it as 2000.0
        year = F.coalesce(cast, F.expr(f"cast(try_cast(`{col}` as double) as int)"))
        return F.when(year.isNull(), F.raise_error(F.concat(F.lit(f"{col}: not a whole number: "), F.coalesce(v, F.lit("(empty)"))))
                      ).otherwise(year)
    return F.when(F.isnan(cast), F.lit(None)).otherwise(cast) if t == "double" else cast


def read_co2_csv(spark: SparkSession, path: str) -> DataFrame:
    """CO2 CSV with a header. Columns are read as text (no inference pass over the
    data). Measures are cast leniently: empty, ``NA``, ``NaN`` and ``null`` become NULL.
    A year that is missing or cannot be read fails the job. Only the known columns that
    exist are kept."""
    raw = spark.read.option("header", True).option("nullValue", "").option("nanValue", "NaN").csv(path)
    return raw.select(*[_typed(c, t).alias(c) for c, t in CO2_RAW_TYPES.items() if c in raw.columns])


def read_indicators(spark: SparkSession, path: str, fmt: str = "parquet", ordered: bool = False) -> DataFrame:
    """Wide indicator table (id, series, one column per year). Year columns are found by
    name later; there values become double, and NaN and text such as ``..`` NULL.
    ``ordered`` adds the rows' place in the files (CSV or Parquet)."""
    if fmt == "csv":
        scan = spark.read.option("header", True).csv(path)
        return with_line_order(scan) if ordered else scan
    scan = spark.read.format(fmt).load(path)
    return with_source_order(scan) if ordered else scan


def read_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    """A year-partitioned Parquet directory in either layout: nested
    ``year=YYYY/...parquet`` (year from the path, pruned) or flat
    ``year=YYYY.parquet`` files (year from the file). Raises when neither exists."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"{path} holds no year=YYYY folder or file")
    nested = [s for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("year=")]
    flat = [s for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().startswith("year=")
            and s.getPath().getName().endswith(".parquet")]
    parts = []
    if nested:
        parts.append(spark.read.option("basePath", path).parquet(*[str(s.getPath()) for s in nested]))
    if flat:
        f = spark.read.parquet(*[str(s.getPath()) for s in flat])
        parts.append(f.withColumn("year", F.coalesce(F.col("year").cast("int"),
                                                     year_from_path(F.col("_metadata.file_path")))))
    if not parts:
        raise FileNotFoundError(f"{path} holds no year=YYYY folder or file")
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.withColumn("year", F.col("year").cast("int"))


def landed_partition_report(spark: SparkSession, path: str, required: list[str],
                            time_col: str = "valid_time", months: int = 12) -> DataFrame:
    """Validity of each landed year: ``year, n_rows, n_months, valid``.

    A year is valid when every one of its files holds the required columns and its rows
    are of ``months`` distinct months. The executors read the footers of all files; a bad
    file makes its year a row of the report and not an error, and the other years' months
    are counted by one aggregate. Tells which years must be loaded again (``years_missing``)."""
    files = partition_files(spark, path, dict.fromkeys(required), exact=False)
    by_year = files.groupBy("year").agg(F.sum("n_rows").alias("n_rows"), F.max(F.size("problems")).alias("bad"))
    years = by_year.collect()       # a row per year
    good = [r.year for r in years if r.bad == 0]
    schema = "year int, n_rows bigint, n_months bigint"
    report = spark.createDataFrame([(r.year, 0, 0) for r in years if r.bad], schema)
    if good:
        # empty years have no month, but they are in the report; the rows' number is in the footers
        rows = spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/year={y}" for y in good])
        seen = (rows.groupBy(F.col("year").cast("int").alias("year")).agg(F.count_distinct(F.month(time_col)).alias("n_months")))
        counted = spark.createDataFrame([(r.year, r.n_rows) for r in years if not r.bad], "year int, n_rows bigint")
        report = report.unionByName(counted.join(F.broadcast(seen), "year", "left").select(
            "year", "n_rows", F.coalesce("n_months", F.lit(0)).alias("n_months")))
    return report.withColumn("valid", (F.col("n_rows") > 0) & (F.col("n_months") == months))
