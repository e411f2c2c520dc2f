"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from daybeat.catalog.oracle import ORACLES
from daybeat.catalog.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_all():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con.sql(ORACLES[name])) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["Date", "AvgHR", "thresh_high", "thresh_low", "rolling_med", "residual",
                          "resid_anomaly", "is_anomaly", "reason"]
    assert df.count() == 30
