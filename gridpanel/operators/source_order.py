"""The order in which rows stand in their files.

Spark's rows have no order of their own, but a file scan knows where each row stands: the
file's path and the row's number in it. Carried along as a sort key, that makes "the first
row in input order" an aggregate like any other (``dedup.keep_first``, ``reshape.pivot_series``),
whatever the partitions are and however often a task runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SOURCE_ORDER = "source_order"


def with_source_order(scan: DataFrame, name: str = SOURCE_ORDER) -> DataFrame:
    """A scan of Parquet files with a struct (path, row number) that sorts like the rows of
    the files read one after the other by path. To be put on the scan itself, before
    anything else."""
    return scan.withColumn(name, F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row")))


def with_line_order(scan: DataFrame, name: str = SOURCE_ORDER) -> DataFrame:
    """The same for text formats (CSV, JSON lines), which do not number their rows: path,
    beginning of the split, and the running number in the task that reads the split from
    its beginning to its end."""
    return scan.withColumn(name, F.struct(F.col("_metadata.file_path").alias("path"),
                                          F.col("_metadata.file_block_start").alias("block"),
                                          F.monotonically_increasing_id().alias("row")))
