"""Every query with an oracle returns the same rows as its DuckDB SQL (driver contract)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "rank", "mid", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["rating_month", "popular_by_month_sql", "load_ratings", "recent_ratings"])
def test_time_queries_ignore_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = entry.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows_of(got) == rows_of(con.execute(entry.oracle_sql()[name]).df())
