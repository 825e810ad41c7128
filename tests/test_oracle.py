"""Every query against its SQL counterpart on the smallest tables."""

import os

import pytest

from marketpulse.catalog.oracle import ORACLE
from marketpulse.catalog.queries import QUERIES
from tools.check import compare, open_oracle

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return open_oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


@pytest.mark.parametrize("name", ["silver_posts", "ohlc_1m", "daily_insights", "parse_ticks", "stream_ohlc"])
def test_the_session_keeps_its_zone_and_results_do_not_depend_on_it(spark, con, name):
    zone = "spark.sql.session.timeZone"
    spark.conf.set(zone, "America/New_York")
    try:
        assert compare(spark, con, name, SF_DIR) is None
        assert spark.conf.get(zone) == "America/New_York"
    finally:
        spark.conf.set(zone, "UTC")
