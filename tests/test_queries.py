"""Every query with SQL gives the same rows as the SQL."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert differences(spark, con, name, entry_point.queries()[name], ORACLES[name], SF) is None


def test_entry_has_all_features(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 3 + 126 + 1
    assert df.count() > 0
