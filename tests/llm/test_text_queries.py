"""The registered queries that SQL can express."""

import pytest
from compare import connect, differences

from buycast.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, name):
    assert differences(spark, connect(SF), name, Q.QUERIES[name], Q.ORACLES[name], SF) is None


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
