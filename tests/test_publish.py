"""Publish: schema check, empty input, CSV + marker, stats; year sets; partition sinks."""

import os

import pytest
from pyspark.sql import functions as F

from gridpanel.functions.years import parse_year_spec, year_from_path
from gridpanel.operators.quality import check_columns
from gridpanel.plans.publish import load_partitions, publish
from gridpanel.session import scratch_path
from gridpanel.sinks.files import read_text, write_csv_if_any, write_year_partitions


def annual(spark):
    return spark.createDataFrame(
        [("b", 2000, 1.5), ("a", 2001, 2.5), ("a", 2000, 0.5), ("a", 2000, 0.25), ("c", 1999, 9.0)],
        "country string, year int, temp_c double")


def test_schema_mismatch_message():
    with pytest.raises(ValueError, match=r"temp_c \(lacking\), x \(not expected\)"):
        check_columns(["country", "year", "x"], {"country", "year", "temp_c"})


def test_publish_roundtrip(spark):
    base = scratch_path(spark, "annual")
    write_year_partitions(annual(spark), base)
    out = scratch_path(spark, "pub") + ".csv"
    s = publish(spark, base, out, 2000, None, success_marker=out + "._SUCCESS")
    assert (s.n_partitions, s.n_countries, s.n_rows, s.y_min, s.y_max) == (2, 2, 3, 2000, 2001)
    text = read_text(spark, out).splitlines()
    assert text == ["country,year,temp_c", "a,2000,0.5", "a,2001,2.5", "b,2000,1.5"]
    assert read_text(spark, out + "._SUCCESS") == "ok\n"


def test_publish_empty_raises(spark):
    base = scratch_path(spark, "annual")
    write_year_partitions(annual(spark), base)
    with pytest.raises(ValueError, match="No rows"):
        publish(spark, base, scratch_path(spark, "pub") + ".csv", 2050, None)


def test_dynamic_overwrite_keeps_other_years(spark):
    base = scratch_path(spark, "annual")
    write_year_partitions(annual(spark), base)
    write_year_partitions(spark.createDataFrame([("z", 2001, 7.0)], "country string, year int, temp_c double"), base)
    got = sorted((r["country"], r["year"]) for r in spark.read.parquet(base).collect())
    assert got == [("a", 2000), ("a", 2000), ("b", 2000), ("c", 1999), ("z", 2001)]


def test_audit_sink_only_when_rows(spark):
    empty = spark.createDataFrame([], "country string, status string")
    assert write_csv_if_any(empty, scratch_path(spark, "audit") + ".csv") is False


def test_year_spec_and_path():
    assert parse_year_spec("2000-2003") == [2000, 2001, 2002, 2003]
    assert parse_year_spec("2001,2000,2001") == [2000, 2001]
    assert parse_year_spec(" 2005 ") == [2005]


def test_year_from_path(spark):
    df = spark.createDataFrame([("/x/year=2003/part.parquet",), ("/x/other.parquet",)], "p string")
    assert [r[0] for r in df.select(year_from_path(F.col("p"))).collect()] == [2003, None]


def test_year_range_variants():
    from gridpanel.functions.years import last_years

    assert parse_year_spec("2022-2023", lists=False) == [2022, 2023]
    assert parse_year_spec("2023", lists=False) == [2023]
    assert last_years(2023) == "2022-2023"
    with pytest.raises(ValueError):
        parse_year_spec("2022,2023", lists=False)
