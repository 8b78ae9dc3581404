"""File sinks: year-partitioned Parquet, one published CSV, success marker.

Paths go through Hadoop's FileSystem API so the same code works on HDFS/S3/GCS
and on local disk; no driver-local temporary folder is used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def write_year_partitions(df: DataFrame, path: str, compression: str = "snappy",
                          partition_col: str = "year") -> None:
    """One directory per year, replaced as a whole (dynamic partition overwrite:
    years not in ``df`` survive); rows with a NULL year are dropped; empty input
    writes no partition. The commit protocol makes each job's output atomic."""
    out = df.where(df[partition_col].isNotNull())
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(partition_col).parquet(path))


def write_single_csv(df: DataFrame, dst: str, header: bool = True, sort: list[str] | None = None) -> str:
    """Publish ``df`` as one CSV file at ``dst``, sorted by ``sort`` (nulls last).

    Written by one task to a staging folder next to ``dst``, sorted inside that task, and
    renamed over ``dst`` in one step: readers see the old file or the new one. Meant for
    publication-size tables (country x year).
    """
    staging = f"{dst}.staging-{uuid.uuid4().hex[:8]}"
    one = df.coalesce(1)
    if sort:
        one = one.sortWithinPartitions(*[one[c].asc_nulls_last() for c in sort])
    one.write.mode("overwrite").option("header", header).csv(staging)
    spark = df.sparkSession
    fs, folder, jvm = _fs(spark, staging)
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one CSV part in {staging}, found {len(parts)}")
    hadoop = jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context.rename(parts[0], fs.makeQualified(hadoop.Path(dst)), options)
    fs.delete(folder, True)
    return dst


def write_csv_if_any(df: DataFrame, dst: str) -> bool:
    """Audit-style sink: written (overwriting) only when there are rows."""
    if df.isEmpty():
        return False
    write_single_csv(df, dst)
    return True


def write_success_marker(spark: SparkSession, path: str, content: str = "ok\n") -> None:
    """Small marker file written after the data; replaces a directory of that name."""
    fs, p, _ = _fs(spark, path)
    if fs.exists(p) and fs.getFileStatus(p).isDirectory():
        fs.delete(p, True)
    out = fs.create(p, True)
    out.write(bytearray(content.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    data = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return data
