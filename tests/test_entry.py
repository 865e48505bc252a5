"""Driver contract and the oracle comparison on the smallest tables."""

import datetime

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.sources.derived import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "contactid" in df.columns and "_silver_loaded_at" in df.columns


def test_every_query_has_an_oracle():
    assert set(E.CORE_QUERIES) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.CORE_QUERIES))
def test_query_matches_oracle(spark, duck, name):
    st = E.queries()[name](spark, SF_SMALL).toArrow()
    dt = duck.sql(E.oracle_sql()[name]).to_arrow_table()
    cols = sorted(st.column_names)
    assert cols == sorted(dt.column_names)
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in st.to_pylist()), key=key)
    b = sorted((tuple(_norm(r[c]) for c in cols) for r in dt.to_pylist()), key=key)
    assert a == b


@pytest.mark.parametrize("name", ["scd2_merge_3", "scd2_from_changes", "metrics_recent", "quarantine_trend",
                                  "date_dim", "fact_lookup", "scd2_as_of", "scd2_transitions"])
def test_session_time_zone_does_not_change_results(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
