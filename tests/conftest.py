import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from gridpanel.session import LOCAL_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def poly(*rings):
    """One part from rings given as [(lon, lat), ...]."""
    return [[{"lon": float(x), "lat": float(y)} for x, y in r] for r in rings]


def regions_df(spark, rows):
    """rows: [(region_id, name, [part, ...])]"""
    return spark.createDataFrame(
        rows, "region_id int, name string, parts array<array<array<struct<lon:double,lat:double>>>>")
