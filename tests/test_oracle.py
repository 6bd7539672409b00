"""Every registered query against its DuckDB statement (the driver's correctness gate, at sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

from tidemark.plans import suite  # noqa: E402

NAMES = list(suite.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    r = compare(spark, SF_SMALL, name, entry.queries()[name], sql, con)
    assert r["spark_rows"] >= 0
    if sql is not None:
        assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "status" in df.columns


ZONE_SENSITIVE = ["wire_timestamp", "progress_parse", "landing_report", "live_state", "recent_updates"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    """Zone-less inputs must give the same answers in a non-UTC session."""
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        r = compare(spark, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert r["match"], r
