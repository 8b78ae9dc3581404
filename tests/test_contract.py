"""Driver contract: entry() runs, every query has a name, oracles are well-formed."""

import duckdb
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "year", "temp_c"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from gridpanel.plans.catalog import QUERIES

    assert set(QUERIES) <= set(o)      # every query of the core has an SQL twin


def test_scratch_folder_only_in_local_mode():
    from types import SimpleNamespace

    from gridpanel.session import ensure_checkpoint_dir

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn",
                         getConf=lambda: {}, setCheckpointDir=lambda d: None)
    cluster = SimpleNamespace(sparkContext=sc, conf={})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)
    sc.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


@pytest.mark.parametrize("name", ["annual_means_box", "annual_means_full", "cover_scanline", "wb_tidy",
                                  "iso3_lookup", "enrich", "nearest_cell"])
def test_query_matches_oracle_at_smoke_scale(spark, name):
    con = duckdb.connect()
    for t in ["nation", "lineitem", "orders", "customer", "supplier", "documents", "embeddings"]:
        con.execute(f"create view {t} as select * from read_parquet('{SMOKE}/{t}.parquet')")
    df = E.queries()[name](spark, SMOKE)
    got = sorted(tuple(None if v is None else v for v in r) for r in df.select(sorted(df.columns)).collect())
    res = con.execute(f"select * from ({E.oracle_sql()[name]}) t")
    cols = [d[0] for d in res.description]
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    exp = sorted(tuple(r[i] for i in idx) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == exp


@pytest.mark.parametrize("name", ["annual_means_box", "fallback_series"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    """The driver's session may use any time zone: month truncation and year
    extraction of the timestamps must give the same result as under UTC."""
    q = E.queries()[name]
    base = sorted(tuple(r) for r in q(spark, SMOKE).collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = sorted(tuple(r) for r in q(spark, SMOKE).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base and base == other
