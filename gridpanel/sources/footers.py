"""Parquet files of a table and what their footers say, read by the executors.

The driver lists nothing and opens nothing: Spark lists the files as rows, and each task
reads the footers of its files (a few kilobytes at the end of each). Where only Spark's
own readers can open a store, the task gets the file's bytes from them instead.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.years import year_from_path

#: Schemes that pyarrow opens by itself.
DIRECT = ("file", "s3", "s3a", "gs", "hdfs", "abfs", "abfss")


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``: ``path, columns`` (name -> type, as Spark
    names types), ``n_rows``, ``error`` (why the footer cannot be read, or null)."""
    scheme = re.match(r"(\w+):", path)
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    direct = (scheme[1] if scheme else default.split(":")[0]) in DIRECT
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path))
    files = files.select("path", F.lit(None).cast("binary").alias("content") if direct else "content")

    def task(batches):      # holds no names of this package: workers need no copy of it
        import re

        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet
        from pyspark.sql.pandas.types import from_arrow_type

        def named(kind):
            try:
                return from_arrow_type(kind).simpleString()
            except Exception:  # noqa: BLE001  (a type that Spark has no name for)
                return str(kind)

        def opened(path, content):
            if content is not None:
                return pa.BufferReader(content)
            fs, name = pa.fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", re.sub(r"^file:/+", "file:///", path)))
            return fs.open_input_file(name)

        for batch in batches:
            rows = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    with opened(path, content) as source:
                        footer = pa.parquet.ParquetFile(source)
                        columns = [(f.name, named(f.type)) for f in footer.schema_arrow]
                        rows.append((path, columns, footer.metadata.num_rows, None))
                except (OSError, pa.ArrowException) as e:
                    rows.append((path, [], 0, f"{type(e).__name__}: {str(e)[:200]}"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.map_(pa.string(), pa.string())),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string())],
                ["path", "columns", "n_rows", "error"])

    return files.mapInArrow(task, "path string, columns map<string,string>, n_rows bigint, error string")


def footer_problems(expected: dict[str, str | None], exact: bool = True) -> Column:
    """Sorted notes on ``columns`` and ``error``: columns that lack, have another type (None:
    any will do) or, where the set must be exact, are not expected."""
    names = F.array(*[F.lit(n) for n in expected])
    typed = {n: t for n, t in expected.items() if t is not None}
    found = F.col("columns")
    notes = [F.transform(F.array_except(names, F.map_keys(found)), lambda n: F.concat(n, F.lit(" (lacking)")))]
    if typed:
        wanted = F.create_map(*[F.lit(x) for pair in typed.items() for x in pair])
        wrong = F.filter(F.map_keys(wanted), lambda n: F.coalesce(found[n] != wanted[n], F.lit(False)))
        notes.append(F.transform(wrong, lambda n: F.concat(n, F.lit(" ("), found[n], F.lit(", not "), wanted[n], F.lit(")"))))
    if exact:
        notes.append(F.transform(F.array_except(F.map_keys(found), names), lambda n: F.concat(n, F.lit(" (not expected)"))))
    return F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.array_sort(F.concat(*notes)))


def partition_files(spark: SparkSession, path: str, expected: dict[str, str | None], exact: bool = True) -> DataFrame:
    """One row per file in a ``year=YYYY`` folder: ``year, path, n_rows, problems``. The year
    itself is in the path, not in the files."""
    files = parquet_footers(spark, path).withColumn("year", year_from_path(F.col("path")))
    return files.where(F.col("year").isNotNull()).select("year", "path", "n_rows", footer_problems(expected, exact).alias("problems"))


def partition_problems(files: DataFrame) -> DataFrame:
    """``year, problem, n_files`` of the files that have one, whichever file of a partition
    it is."""
    return (files.select("year", "path", F.explode("problems").alias("problem"))
            .groupBy("year", "problem").agg(F.count_distinct("path").alias("n_files")))
