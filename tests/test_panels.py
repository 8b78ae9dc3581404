"""Cleaning, reshape, dedup, names, text fold."""

import pytest
from pyspark.sql import functions as F

from gridpanel.functions.text import fold_ascii, fold_ascii_py
from gridpanel.operators.clean import iso3_only, keep_iso3_year
from gridpanel.operators.dedup import keep_first
from gridpanel.operators.names import add_iso3, unmapped_names
from gridpanel.operators.reshape import melt_years, pivot_series
from gridpanel.plans.panels import clean_co2, tidy_indicators


def test_codes_upper_before_length(spark):
    df = spark.createDataFrame([(None,), ("usa",), ("US",), ("OWID_WRL",), (" USA",), ("OWI",)], "iso3 string")
    got = sorted(r["iso3"] for r in iso3_only(df, upper=True, drop_owid=True).collect())
    assert got == ["OWI", "USA"]          # only the OWID prefix is an aggregate marker
    got2 = sorted(r["iso3"] for r in iso3_only(df, upper=False).collect())
    assert got2 == ["OWI", "usa"]


def test_clean_co2_subset_and_range(spark):
    raw = spark.createDataFrame(
        [("usa", 1999, 1.0, 2.0, 7.0), ("OWID_WRL", 2000, 1.0, 2.0, 7.0), ("fra", 2001, 3.0, 4.0, 7.0)],
        "iso_code string, year long, co2 double, co2_per_capita double, extra double")
    out = clean_co2(raw, 2000, None)
    assert out.columns == ["iso3", "year", "co2_mt", "co2_t_per_capita"]
    assert [tuple(r) for r in out.collect()] == [("FRA", 2001, 3.0, 4.0)]


def test_melt_pivot_roundtrip(spark):
    wide = spark.createDataFrame(
        [("ABC", "GE.EST", 1.0, None, 5.0), ("ABC", "RL.EST", 2.0, 3.0, None), ("XYZ", "GE.EST", None, None, None)],
        "Economy string, Series string, YR2000 double, yr2001 double, yrbad double")
    long_ = melt_years(wide.toDF("iso3", "series", "yr2000", "yr2001", "yrbad"), ["iso3", "series"])
    bad = long_.where(F.col("year").isNull()).count()
    assert bad == 3                                   # the yrbad column -> NULL years
    tidy = tidy_indicators(wide).orderBy("iso3", "year").collect()
    assert [(r["iso3"], r["year"], r["wgi_gov_effectiveness"], r["wgi_rule_of_law"]) for r in tidy] == [
        ("ABC", 2000, 1.0, 2.0), ("ABC", 2001, None, 3.0)]   # XYZ: no value at all -> absent
    # R2 . R1 is the identity on non-null cells
    back = pivot_series(long_.where(F.col("year").isNotNull()), ["iso3", "year"], "series", ["GE.EST", "RL.EST"])
    cells = {(r["iso3"], r["year"], s): r[s] for r in back.collect() for s in ("GE.EST", "RL.EST") if r[s] is not None}
    orig = {(r["iso3"], r["year"], r["series"]): r["value"]
            for r in long_.where(F.col("value").isNotNull() & F.col("year").isNotNull()).collect()}
    assert cells == orig


def test_keep_first_is_deterministic_and_idempotent(spark):
    df = spark.createDataFrame([("a", 1, 2, "fb"), ("a", 1, 0, "direct"), ("b", 2, 5, "x"), ("a", 2, 1, "y")],
                               "country string, year int, priority int, src string")
    once = keep_first(df, ["country", "year"], ["priority"])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == [("a", 1, 0, "direct"), ("a", 2, 1, "y"), ("b", 2, 5, "x")]
    assert sorted(tuple(r) for r in keep_first(once, ["country", "year"], ["priority"]).collect()) == rows


def test_keep_iso3_year(spark):
    df = spark.createDataFrame([("fra", 2000.0, 2), ("FRA", 2000.0, 1), (None, 2000.0, 0), ("fr", 2000.0, 0)],
                               "iso3 string, year double, k int")
    out = keep_iso3_year(df, ["k"]).collect()
    assert [(r["iso3"], r["year"], r["k"]) for r in out] == [("FRA", 2000, 1)]


@pytest.mark.parametrize("name, code", [
    ("Türkiye", "TUR"), ("Turkey", "TUR"), (" Kosovo ", "XKX"), ("CONGO", "COG"),
    ("Dhekelia Sovereign Base Area", None), ("Atlantis", None), ("DE", "DEU"), ("usa", "USA"),
    ("840", "USA"), ("republic of india", "IND"), ("Åland Islands", "ALA"),
    ("São Tomé and Príncipe", "STP"), ("Bolivia", "BOL"),
])
def test_iso3_cascade(spark, name, code):
    df = spark.createDataFrame([(name,)], "country string")
    assert add_iso3(df).collect()[0]["iso3"] == code


def test_null_name_and_unmapped(spark):
    df = spark.createDataFrame([(None,), ("Atlantis",), ("Atlantis",), ("France",)], "country string")
    m = add_iso3(df)
    assert m.where(F.col("country").isNull()).collect()[0]["iso3"] is None
    u = unmapped_names(m).collect()
    assert [(r["country"], r["n_unmapped"]) for r in u] == [("Atlantis", 1)]


def test_fold_matches_python(spark):
    samples = ["  Côte d'Ivoire\n", " Ærø ﬁnal ½ ㎏ 𝐀𝐁　", "straße", "Ελλάδα", "", "plain ascii",
               "ǅemal  ", "\x1cx\x1d"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["f"] for r in df.select(fold_ascii(F.col("s")).alias("f")).collect()]
    assert got == [fold_ascii_py(s) for s in samples]
